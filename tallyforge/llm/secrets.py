"""Secret scans with an incremental blob ledger: each content is scanned once for each rule version."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, shared_dir, staged


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group``/``least``: matches whose group is shorter are dropped after they have been consumed.
    ``hints``: texts that hold none of these strings can't match."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", hints=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("PRIVATE KEY-----",)),
    Rule("github", 1, r"gh[opsur]_[A-Za-z0-9]{36,}", hints=("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
    # a run of token characters is consumed once, and dropped where no two parts of the right form follow, so that the work on
    # a text grows with its length whatever it holds
    Rule("jwt", 3, r"eyJ[A-Za-z0-9_-]{8,}(\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})?", 1, 1, hints=("eyJ",)),
    # (of a scheme, the last 21 characters at most belong to the span)
    Rule("url", 3, r"[A-Za-z][A-Za-z0-9+.-]{0,20}://[^\s:@/]+:[^\s:@/]+@", hints=("://",)),
)
BASE = ("assign", "access", "hex")
FINDING = "array<struct<start:long,stop:long>>"
#: Matches that one step of the fold lists, so that a text of n matches copies n * (RUN + n / RUN) of them, not n * n.
RUN = 256
#: Parts that the rows of one content are dealt to when findings are joined back.
SALT = 16
LEDGER, FINDINGS = "blob string, rule string", "blob string, rule string, kind string, start long, stop long"


def blob_id(text: Column) -> Column:
    """Content address: SHA-256 of the UTF-8 text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def spans(text: Column, rule: Rule) -> Column:
    """Code-point spans (start, stop exclusive) of a rule's leftmost, non-overlapping matches.

    The text is split at the matches, so that lengths of gaps and matches add up to positions.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x).cast("long"))
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x).cast("long"))
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x) >= rule.least)
    none = F.expr(f"cast(array() as {FINDING})")
    rows = F.zip_with(F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, n: F.struct(g.alias("gap"), n.alias("size"))), checked, lambda x, ok: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), ok.alias("good")))

    def one(acc, x):
        at = acc["upto"] + x["gap"]
        hit = F.when(x["good"], F.array(F.struct(at.alias("start"), (at + x["size"]).alias("stop")))).otherwise(none)
        return F.struct((at + x["size"]).alias("upto"), F.concat(acc["out"], hit).alias("out"))

    def run(acc, part):
        here = F.aggregate(part, F.struct(acc["upto"].alias("upto"), none.alias("out")), one)
        return F.struct(here["upto"].alias("upto"), F.concat(acc["out"], F.array(here["out"])).alias("out"))

    zero = F.lit(0).cast("long")
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / RUN).cast("int")), lambda i: F.slice(rows, i * RUN + 1, F.lit(RUN)))
    start = F.struct(zero.alias("upto"), F.expr(f"cast(array() as array<{FINDING}>)").alias("out"))
    return F.when(F.size(rows) == 0, none).otherwise(F.aggregate(runs, start, run, lambda acc: F.flatten(acc["out"])))


def _scanned(text: Column, rule: Rule, due: Column) -> Column:
    hinted = due
    if rule.hints:
        hint = F.lit(False)
        for h in rule.hints:
            hint = hint | text.contains(h)
        hinted = hinted & hint
    return F.when(hinted & text.rlike(rule.pattern), spans(text, rule))


def scan(versions: DataFrame, text_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(findings, ledger entries) of the contents in ``versions`` that the ledger has not seen under some rule version.

    findings: (blob, rule, kind, start, stop); ledger entries: (blob, rule), also for blobs without a finding. Each content
    is scanned in one of the rows that hold it (the smallest id; rows that repeat its id too), where it lies: only content
    addresses and ids are shuffled, as long as the rows to scan or those to leave out are few enough to be sent to every
    task. Null and empty texts are one content. An empty table gives empty results.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    rows = versions.select(blob_id(F.col(text_col)).alias("blob"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keys = staged(rows.select("blob", "id"), "blobs")
    due = keys.groupBy("blob").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("at")).select("blob", F.col("at.id").alias("id"))
    if ledger is None:
        due = due.withColumn("due", names)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        due = due.join(seen, "blob", "left").select("blob", "id", F.when(F.col("seen").isNull(), names).otherwise(F.array_except(names, "seen")).alias("due")).where(F.size("due") > 0)
    due = staged(due, "blobs-due")
    same = lambda a, b: (a["blob"] == b["blob"]) & a["id"].eqNullSafe(b["id"])
    skipped = staged(keys.join(due, same(keys, due), "left_anti").distinct(), "blobs-skipped")
    if ledger is None and skipped.count() <= BROADCAST_ROWS:
        held = F.broadcast(skipped)
        todo = rows.join(held, same(rows, held), "left_anti").withColumn("due", names)
    else:
        held = F.broadcast(due) if due.count() <= BROADCAST_ROWS else due
        todo = rows.join(held, same(rows, held)).select(rows["blob"], rows["text"], held["due"])
    marked = todo.select("blob", *[_scanned(F.col("text"), r, F.array_contains("due", r.name)).alias(r.kind) for r in rules])
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.col(r.kind).alias("at")) for r in rules])
    hits = marked.select("blob", F.explode(F.filter(each, lambda x: F.size(x["at"]) > 0)).alias("x"))
    findings = hits.select("blob", "x.rule", "x.kind", F.explode("x.at").alias("s")).select("blob", "rule", "kind", "s.start", "s.stop").distinct()
    return findings, due.select("blob", F.explode("due").alias("rule"))


class Ledger:
    """Two tables below one folder: which (blob, rule version) pairs have been scanned, and what was found.

    ``update`` scans only unseen pairs and appends; findings go first, so that a run that is lost in between is scanned again
    and its findings, which can't differ, are told apart from no others when they are read.
    """

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if there else self.spark.createDataFrame([], schema)

    def seen(self) -> DataFrame:
        return self._read("ledger", LEDGER)

    def findings(self) -> DataFrame:
        return self._read("findings", FINDINGS).distinct()

    def update(self, versions: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> None:
        seen = self.seen()
        found, entries = scan(versions, text_col, None if seen.isEmpty() else seen, rules, id_col)
        found.write.mode("append").parquet(f"{self.folder}/findings")
        entries.write.mode("append").parquet(f"{self.folder}/ledger")


def scan_all(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, folder: str | None = None) -> DataFrame:
    """(id, blob, spans) of every row: the ledger in ``folder`` is brought up to date (a new one in the shared folder if none
    is given), then all stored findings of the rules' present versions are joined back to all rows."""
    ledger = Ledger(versions.sparkSession, folder or f"{shared_dir(versions.sparkSession)}/tallyforge-secrets-{uuid.uuid4().hex}")
    ledger.update(versions, text_col, id_col, rules)
    current = ledger.findings().where(F.col("rule").isin(*[r.name for r in rules]))
    return findings_by_row(versions, current, id_col, text_col, rules)


def findings_by_row(versions: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, blob, spans): every row of ``versions`` with all findings of its content, by start and then in rule order; spans
    is null without any. The rows of one content are dealt to ``SALT`` parts, so copies don't meet in one task."""
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    lists = findings.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "stop", "kind"))).alias("spans"))
    lists = lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    rows = versions.select(F.col(id_col).alias("id"), blob_id(F.col(text_col)).alias("blob"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int"))
    return rows.join(lists, ["blob", "part"], "left").select("id", "blob", "spans")


def span_text(column: Column) -> Column:
    """kind:start:stop, comma-joined; "" for no spans."""
    return F.coalesce(F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","), F.lit(""))


def _rule_sql(i: int, r: Rule) -> str:
    p = r.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{r.kind}' AS kind, {i} AS rank, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda k: {{
      'a': list_sum(list_transform(g[1:k], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0)::BIGINT,
      'n': length(m[k])::BIGINT, 'v': length(v[k])::BIGINT}}), lambda s: s.v >= {r.least})) AS s
  FROM (SELECT doc_id, string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS v FROM texts WHERE regexp_matches(t, '{p}'))"""


SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(RULES))}),
flat AS (SELECT doc_id, kind, rank, s.a AS a, kind || ':' || s.a || ':' || (s.a + s.n) AS label FROM found),
sums AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(label, ',' ORDER BY a, rank) FILTER (rank < {len(BASE)}) AS base, string_agg(label, ',' ORDER BY a, rank) AS spans
  FROM flat GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""
