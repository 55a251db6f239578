"""URL filters: a given policy of host and path rules, and association rules between URL tokens and labels for the rest."""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop_staged, for_join, fresh, staged

#: Policy of the query: verdict, host and path.
POLICY = ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")
#: Share of the labelled rows that hold a combination and its label, and share of a combination's rows that have the label.
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.6
#: Labelled rows below which a combination proves nothing, however few there are in all.
MIN_ROWS = 10
#: Place in a labelled row, the most telling token first, up to which FP-growth combines tokens. It has no bound on the
#: length of its combinations, so such a row gives at most 2 ** MOST_TOKENS of them; combinations with a token that stands
#: further back in any row are grown by ``_beyond``, so all are mined. (The SQL statement enumerates, and stops at this place.)
MOST_TOKENS = 12
#: Tokens longer than this stand as their hash.
TOKEN_CHARS = 64
LABELS = ("allow", "block")
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, labels and domains of the host, path segments with numbers as ``#``, names of
    query parameters, whether there is a fragment. Null has none."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    domains = F.array(F.concat(F.lit("domain "), F.array_join(F.slice(labels, -2, 2), ".")), F.concat(F.lit("host "), host))
    segments = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda x: x != "")
    query = F.filter(F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    named = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(f"{kind} "), x))
    found = F.concat(
        F.when(F.locate("://", url) > 0, F.array(F.concat(F.lit("scheme "), F.lower(F.substring_index(url, "://", 1))))).otherwise(F.array().cast("array<string>")),
        named("label", labels),
        F.when(F.size(labels) > 1, domains).otherwise(F.array().cast("array<string>")),
        named("path", segments),
        named("query", F.transform(query, lambda x: F.substring_index(x, "=", 1))),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    short = F.transform(found, lambda t: F.when(F.length(t) > TOKEN_CHARS, F.sha2(t, 256)).otherwise(t))
    return F.coalesce(F.array_distinct(short), F.array().cast("array<string>"))


def by_policy(rows: DataFrame, policy: Sequence[str], host: str, path: str, rule: str, verdict: str) -> DataFrame:
    """``rows`` with the longest rule (host and path, like ``net/es/``) that fits, and its verdict; null if none does.

    A rule fits its host and all subdomains, if the path starts with the rule's; of two equally long ones the longer host
    wins, then ``allow``. The policy is a list that the caller holds, so it is small enough to be sent to every task: rules are
    looked up by the last labels of the host, one join for each number of labels that rules have, and rows stay where they are.
    """
    split = []
    for entry in policy:
        said, pattern = entry.split(" ", 1)
        if said not in LABELS or not pattern.split("/", 1)[0]:
            raise ValueError(f"rule {entry!r}")
        on, slash, below = pattern.partition("/")
        split.append((on.lower(), slash + below, said))
    depth = lambda on: on.count(".") + 1
    spark = rows.sparkSession
    best, at, of, rules_of = [], *fresh(rows, "at", "of", "rules")
    for n in sorted({depth(on) for on, _, _ in split}):
        by_host: dict[str, set] = {}
        for on, below, said in split:
            if depth(on) == n:
                by_host.setdefault(on, set()).add((-len(on + below), said, below))
        table = spark.createDataFrame([(on, [(below, said) for _, said, below in sorted(rs)]) for on, rs in sorted(by_host.items())], f"`{of}` string, `{rules_of}` array<struct<path:string,verdict:string>>")
        last = F.substring_index(F.col(host), ".", -n)
        last = F.when(F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) >= n - 1, last)
        rows = rows.withColumn(at, last).join(F.broadcast(table), F.col(at) == F.col(of), "left")
        fits = F.filter(rules_of, lambda r: F.startswith(F.col(path), r["path"]))
        name = f"{rules_of}{n}"
        one = F.try_element_at(fits, F.lit(1))
        long = F.concat(F.col(of), one["path"])
        rows = rows.withColumn(name, F.when(F.size(fits) > 0, F.struct(F.length(long).alias("length"), F.length(of).alias("host"), (one["verdict"] == "allow").alias("allows"), one["verdict"].alias("verdict"), long.alias("rule")))).drop(at, of, rules_of)
        best.append(name)
    top = F.array_max(F.array(*best)) if best else F.lit(None).cast("struct<rule:string,verdict:string>")  # (nulls are passed over)
    return rows.withColumn(at, top).withColumn(rule, F.col(at)["rule"]).withColumn(verdict, F.col(at)["verdict"]).drop(at, *best)


@dataclass(frozen=True)
class Rules:
    """Mined rules (rule_id, tokens, first, verdict, confidence, support; ``first`` being the rarest of the tokens), the tokens
    that stand in one, and the verdict where none fits."""

    table: DataFrame
    tokens: list[str]
    otherwise: str


def _vocabulary(labelled: DataFrame, n: int, blocked: int, min_support: float) -> list[str]:
    """Tokens that may be in a rule, the most telling first: those of enough rows, and of tokens that stand on exactly the
    same rows only the first by name (they would double every combination). There are at most (tokens of a row) /
    ``min_support`` of them, each of bounded length."""
    at = F.pmod(F.xxhash64("tokens", "label", "n"), F.lit(1 << 40)).cast("decimal(20,0)") * F.col("n")
    per = labelled.select(F.explode("tokens").alias("token"), at.alias("at"), "n", F.when(F.col("label") == "block", F.col("n")).otherwise(0).alias("block"))
    per = per.groupBy("token").agg(F.sum("n").alias("rows"), F.sum("at").alias("at"), F.sum("block").alias("block")).where(F.col("rows") >= min_support * n)
    one = per.groupBy("rows", "at", "block").agg(F.min("token").alias("token"))
    # how far the share of blocked rows lies from that of all, in standard deviations
    far = F.abs(F.col("block") - F.col("rows") * (blocked / n)) / F.sqrt("rows")
    return [r.token for r in one.orderBy(far.desc(), "token").select("token").collect()]


def _beyond(rows: DataFrame, far: list[str], least: int) -> DataFrame:
    """(tokens, block, allow, can_block, can_allow): the combinations with a token of ``far`` that a rule may be made of, and
    their rows by label, from ``rows`` (told, block, allow; ``told`` in one order of all tokens, which ``far`` are apart in).

    A combination grows from its last token in that order towards the first. Rules are kept for a label only if no part is
    as sure of it, so each token must take rows of the other label away from what the rest of the combination holds; and
    what fails this, or has fewer than ``least`` rows of the label, fails in every longer combination too. So tokens that go
    together, of which a row of thirty has 2 ** 30 combinations, end at a few of them, and nothing that could be kept is lost.
    """
    labels = (("block", "allow"), ("allow", "block"))
    sums = [F.sum(c).alias(c) for c in LABELS]
    far_too = lambda token: F.array_contains(F.array(*map(F.lit, far)), token)
    level = rows.select(F.explode("told").alias("token"), *LABELS).groupBy(F.array("token").alias("tokens")).agg(*sums)
    level = staged(level.withColumns({f"can_{v}": F.col(v) >= least for v in LABELS}), "url-level")
    found = level.where(far_too(F.col("tokens")[0]))
    held = rows.select(F.posexplode("told").alias("i", "token"), "told", *LABELS).where(far_too(F.col("token")))
    held = staged(held.select(F.array("token").alias("tokens"), F.slice("told", F.lit(1), F.col("i")).alias("before"), *LABELS), "url-held")
    while True:
        longer = held.select("tokens", "before", *LABELS, F.posexplode("before").alias("i", "token"))
        longer = longer.select(F.array_append("tokens", F.col("token")).alias("tokens"), F.slice("before", F.lit(1), F.col("i")).alias("before"), *LABELS)
        counts = longer.groupBy("tokens").agg(*sums).where(F.greatest(*LABELS) >= least)
        parts = F.transform("tokens", lambda t: F.array_remove("tokens", t))
        parts = F.filter(parts, lambda p: (F.size(p) == 1) | far_too(p[0]))  # (others are not in ``level``)
        of_part = level.select(F.col("tokens").alias("part"), F.struct(*LABELS, "can_block", "can_allow").alias("p"))
        fits = {v: F.bool_and((F.col(v) >= least) & F.coalesce(F.col("p")[f"can_{v}"] & (F.col(w) < F.col("p")[w]), F.lit(False))).alias(f"can_{v}") for v, w in labels}
        tested = counts.withColumn("part", F.explode(parts)).join(of_part, "part", "left").groupBy("tokens", *LABELS).agg(*fits.values())
        level = staged(tested.where("can_block or can_allow"), "url-level")
        found = found.unionByName(level)
        grows = for_join(level.where("(can_block and allow > 0) or (can_allow and block > 0)").select("tokens"), "url-grows")
        further = longer.where(F.size("before") > 0).join(grows, "tokens").groupBy("tokens", "before").agg(*sums)
        further = staged(further, "url-held")
        drop_staged(held)
        held = further
        if held.isEmpty():
            return found


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> Rules:
    """Association rules from labelled URLs (url, label: "allow" or "block") by FP-growth over all of them, and for
    combinations with tokens far back in a long row by ``_beyond``: none is left out for its length or its row's.

    A rule says that rows with a combination of tokens have a label. It is kept with ``min_support`` of all rows (``MIN_ROWS``
    at least) and ``min_confidence`` of those with the combination, if no part of its combination says the same with as much confidence.
    Rows with another label or none are left out. Without rows there are no rules, and the verdict is "allow"; else it is the
    more frequent label's (of equal ones "allow").
    """
    spark = labelled.sparkSession
    known = labelled.where(F.col("label").isin(*LABELS)).select(tokens_of(F.col("url")).alias("tokens"), "label")
    known = staged(known.groupBy("tokens", "label").agg(F.count("*").alias("n")), "url-labels")  # (equal URLs meet here)
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    blocked, n = counts.get("block", 0), sum(counts.values())
    empty = spark.createDataFrame([], "rule_id long, tokens array<string>, first string, verdict string, confidence double, support double")
    otherwise = "block" if 2 * blocked > n else "allow"
    if not n:
        return Rules(empty, [], otherwise)
    min_support = max(min_support, MIN_ROWS / n)
    words = _vocabulary(known, n, blocked, min_support)
    if not words or min_support > 1:
        return Rules(empty, [], otherwise)
    told = F.array_intersect(F.array(*map(F.lit, words)), F.col("tokens"))
    behind = known.select(F.explode(F.slice(told, MOST_TOKENS + 1, len(words))).alias("token")).distinct()
    behind = {r.token for r in behind.collect()}  # some of ``words``; the others stand within MOST_TOKENS places of every row
    near, far = [w for w in words if w not in behind], [w for w in words if w in behind]
    baskets = known.select(F.array_append(F.filter(told, lambda t: t.isin(near)) if far else told, F.concat(F.lit("= "), "label")).alias("items"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i")).select("items")
    found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets).associationRules
    rules = found.where(F.startswith(F.col("consequent")[0], F.lit("= "))).select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 3, 9).alias("verdict"), "confidence", "support")
    if far:
        by_label = [F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(v) for v in LABELS]
        rows = staged(known.groupBy(told.alias("told")).agg(*by_label), "url-rows")
        grown = _beyond(rows, far, math.ceil(min_support * n))
        for v in LABELS:
            sure = (F.col(v) / (F.col("block") + F.col("allow"))).alias("confidence")
            rules = rules.unionByName(grown.where(f"can_{v}").select(F.array_sort("tokens").alias("tokens"), F.lit(v).alias("verdict"), sure, (F.col(v) / n).alias("support")).where(F.col("confidence") >= min_confidence))
    rules = rules.withColumn("rule_id", F.xxhash64("tokens", "verdict"))
    rank = F.map_from_arrays(F.array(*map(F.lit, words)), F.array(*map(F.lit, range(len(words)))))
    rules = staged(rules.withColumn("first", F.array_min(F.transform("tokens", lambda t: F.struct(rank[t].alias("rank"), t.alias("token"))))["token"]), "url-rules")
    part = rules.select(F.col("rule_id").alias("by"), F.col("verdict").alias("says"), F.col("confidence").alias("sure"), F.size("tokens").alias("length"))
    inside = matches(rules.select("rule_id", "tokens", "verdict", "confidence"), rules.select("tokens", "first", F.col("rule_id").alias("by")), "tokens").join(part, "by")
    doubled = inside.where((F.col("by") != F.col("rule_id")) & (F.col("says") == F.col("verdict")) & (F.col("length") < F.size("tokens")) & (F.col("sure") >= F.col("confidence")))
    kept = staged(rules.join(doubled.select("rule_id").distinct(), "rule_id", "left_anti"), "url-rules")
    drop_staged(rules), drop_staged(known)
    used = {r.token for r in kept.select(F.explode("tokens").alias("token")).distinct().collect()}  # some of ``words``
    return Rules(kept, [w for w in words if w in used], otherwise)


def matches(sets: DataFrame, rules: DataFrame, column: str) -> DataFrame:
    """``sets`` joined to every rule (tokens, first, ...) whose tokens all stand in their array ``column``: an inverted index
    that holds each rule under one of its tokens gives the candidates, which are then compared."""
    token, rule, first = fresh(sets, "token", "rule", "first")
    index = for_join(rules.withColumnRenamed("tokens", rule).withColumnRenamed("first", first), "url-index")
    probes = sets.withColumn(token, F.explode(column))
    return probes.join(index, F.col(token) == F.col(first)).where(F.size(F.array_except(rule, column)) == 0).drop(token, first, rule)


def by_rules(urls: DataFrame, rules: Rules, url: str, verdict: str) -> DataFrame:
    """``urls`` with the verdict of the surest rule that fits (then the best supported, then "block", then by id), or the
    one where none does. Only the tokens that stand in a rule matter, and few combinations of those occur: each is matched once
    and its verdict joined back, so no URL is shuffled for it."""
    if not rules.tokens:
        return urls.withColumn(verdict, F.lit(rules.otherwise))
    key, said, tokens = fresh(urls, "key", "said", "tokens")
    keyed = urls.withColumn(key, F.array_intersect(F.array(*map(F.lit, rules.tokens)), tokens_of(F.col(f"`{url}`"))))
    sets = keyed.select(F.col(key).alias("tokens")).distinct()
    best = F.max_by("verdict", F.struct("confidence", "support", (F.col("verdict") == "block").alias("block"), "rule_id")).alias(said)
    decided = for_join(matches(sets, rules.table, "tokens").groupBy(F.col("tokens").alias(tokens)).agg(best), "url-decided")
    return keyed.join(decided, F.col(key) == F.col(tokens), "left").withColumn(verdict, F.coalesce(said, F.lit(rules.otherwise))).drop(key, tokens, said)


def filter_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", policy: Sequence[str] = POLICY, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``; ``rule`` is null where the policy is silent.

    There the verdict comes from mined rules. They are learned from the URLs that the policy judges, and from the others
    whose page has a label in ``labels`` (id, label: "allow" or "block"; of several of an id "block" counts).

    A null URL, and one without ``://``, has an empty host and path; so has an empty one. Long URLs are read whole, repeated
    rows repeat, ties are broken as ``by_policy`` and ``by_rules`` say, an empty table gives none, other columns are not read.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    judged = by_policy(rows, policy, "host", "path", "rule", "said")
    known = labels.where(F.col("label").isin(*LABELS) & F.col("id").isNotNull()).groupBy(F.col("id").alias("of")).agg(F.max("label").alias("label"))
    silent = judged.where("rule is null").join(known, F.col("id") == F.col("of")).select("url", "label")
    rules = mine(judged.where("rule is not null").select("url", F.col("said").alias("label")).unionByName(silent), min_support, min_confidence)
    out = by_rules(judged, rules, "url", "mined")
    return out.select("id", "host", "path", "rule", F.coalesce("said", "mined").alias("verdict"))


def _policy_sql() -> str:
    rows = [(said, *pattern.partition("/")) for said, pattern in (entry.split(" ", 1) for entry in POLICY)]
    return ", ".join(f"('{said}', '{on}', '{slash}{below}')" for said, on, slash, below in rows)


#: The query's result with every combination of a row's tokens enumerated.
SQL = f"""
WITH policy(said, h, p) AS (VALUES {_policy_sql()}),
u AS (
  SELECT row_number() OVER () AS r, page_id, url, coalesce(translate(regexp_extract(url, '{_PARTS}', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') AS host, coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages),
fit AS (
  SELECT r, arg_max(h || p, (length(h || p), length(h), said = 'allow')) AS rule, arg_max(said, (length(h || p), length(h), said = 'allow')) AS said
  FROM u JOIN policy ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
parts AS (
  SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS ls, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> '') AS ps,
    list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '') AS qs FROM u),
found AS (
  SELECT r, page_id, list_concat(CASE WHEN contains(url, '://') THEN ['scheme ' || lower(split_part(url, '://', 1))] ELSE [] END, list_transform(ls, lambda x: 'label ' || x),
    CASE WHEN len(ls) > 1 THEN ['domain ' || array_to_string(ls[-2:], '.'), 'host ' || host] ELSE [] END, list_transform(ps, lambda x: 'path ' || x),
    list_transform(qs, lambda x: 'query ' || split_part(x, '=', 1)), CASE WHEN contains(url, '#') THEN ['fragment'] ELSE [] END) AS ts FROM parts),
tokens AS (SELECT DISTINCT r, page_id, CASE WHEN length(t) > {TOKEN_CHARS} THEN sha256(t) ELSE t END AS token FROM (SELECT r, page_id, unnest(ts) AS t FROM found) WHERE t IS NOT NULL),
told AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 'allow' WHEN 0 THEN 'block' END) AS label FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
known AS (SELECT u.r, coalesce(said, label) AS label FROM u LEFT JOIN fit ON u.r = fit.r LEFT JOIN told ON said IS NULL AND page_id = doc_id WHERE coalesce(said, label) IS NOT NULL),
n AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (label = 'block')::DOUBLE AS b, greatest({MIN_SUPPORT}::DOUBLE, {MIN_ROWS} / count(*)::DOUBLE) AS least FROM known),
often AS (SELECT token, count(*) AS c, count(*) FILTER (label = 'block') AS blocked, list(r ORDER BY r) AS held_by FROM tokens JOIN known USING (r), n GROUP BY token, n.n, n.least HAVING count(*) >= n.least * n.n),
ranked AS (SELECT token, row_number() OVER (ORDER BY abs(blocked - c * (n.b / n.n)) / sqrt(c) DESC, token) AS k FROM (SELECT min(token) AS token, c, blocked FROM often GROUP BY held_by, c, blocked), n),
sets AS (SELECT r, list(k ORDER BY k) AS ks FROM tokens JOIN ranked USING (token) GROUP BY r),
baskets AS (SELECT r, label, ks[1:{MOST_TOKENS}] AS ks FROM known JOIN sets USING (r)),
masks AS (SELECT label, ks, unnest(range(1, (1 << len(ks))::BIGINT)) AS mask FROM baskets),
combos AS (SELECT label, list_transform(list_filter(range(0, len(ks)), lambda i: (mask >> i) & 1 = 1), lambda i: ks[i + 1]) AS c FROM masks),
counts AS (SELECT c, count(*) AS held, count(*) FILTER (label = 'block') AS block, count(*) FILTER (label = 'allow') AS allow FROM combos GROUP BY c),
said AS (SELECT c, held, 'block' AS v, block AS hits FROM counts UNION ALL SELECT c, held, 'allow', allow FROM counts),
sure AS (SELECT c, v, hits / held::DOUBLE AS confidence, hits / n.n AS support FROM said, n WHERE hits >= ceil(n.least * n.n) AND hits / held::DOUBLE >= {MIN_CONFIDENCE}),
rules AS (SELECT * FROM sure s WHERE NOT EXISTS (SELECT 1 FROM sure g WHERE g.v = s.v AND len(g.c) < len(s.c) AND g.confidence >= s.confidence AND list_has_all(s.c, g.c))),
mined AS (SELECT r, arg_max(v, (confidence, support, v = 'block')) AS v FROM sets JOIN rules ON list_has_all(ks, c) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(said, v, CASE WHEN 2 * n.b > n.n THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit USING (r) LEFT JOIN mined USING (r), n
"""
