"""Site-relative line dedup: a line found on too large a share of a host's pages is boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, fresh, staged

RATIO = 0.05
#: Pages that a line must stand on to repeat at all: without it each line of a host of a few pages would be over the ratio.
MIN_PAGES = 2
#: Parts that a host's rows are dealt to where the lists of lines are too large to be sent to every task.
SALT = 16


def _key(host: Column, line: Column) -> Column:
    """128 bits for a line of a host, so that the joins carry no text."""
    return F.struct(F.xxhash64(host, line).alias("a"), F.xxhash64(line, F.lit("line"), host).alias("b"))


def boilerplate_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, fold_copies: bool = False) -> DataFrame:
    """(host, key, n_pages, host_pages) of each line that stands on more than ``ratio`` of its host's pages.

    Every row with a text is a page; with ``fold_copies`` the rows of a host that have the same text are one page. Lines are
    compared without outer spaces; blank ones never count. Null hosts form one host of their own.
    """
    pages = docs.where(F.col(text_col).isNotNull()).select(
        F.col(host_col).alias("host"), F.struct(F.xxhash64(F.col(text_col)).alias("a"), F.xxhash64(F.lit("page"), F.col(text_col)).alias("b")).alias("page"), F.transform(F.split(F.col(text_col), "\n"), lambda x: F.trim(x)).alias("lines")
    )
    count = F.count_distinct("page") if fold_copies else F.count("page")
    totals = pages.groupBy("host").agg(count.alias("host_pages"))
    lines = pages.select("host", "page", F.explode(F.array_distinct("lines")).alias("line")).where("line <> ''")
    counts = lines.select("host", "page", _key(F.col("host"), F.col("line")).alias("key")).groupBy("host", "key").agg(count.alias("n_pages"))
    often = counts.where(F.col("n_pages") >= min_pages).withColumnRenamed("host", "of")
    found = often.join(totals, often["of"].eqNullSafe(totals["host"])).where(F.col("n_pages") > F.lit(float(ratio)) * F.col("host_pages"))
    return found.select("host", "key", "n_pages", "host_pages")


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, fold_copies: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines cut out of the text, and two more columns: n_lines and n_dropped (long).

    A host has at most (lines of a page / ratio) boilerplate lines, so each host's keys are one short list, and rows meet
    the list of their host: sent to every task while all lists have at most ``BROADCAST_ROWS`` keys, else joined with each
    host's rows dealt to ``SALT`` parts. Texts are not shuffled in the first case.

    All rows and columns stay; a text may become empty. Null text: null, no lines. Empty text: one blank line. Repeated
    rows and repeated or null ids are treated row by row, very long texts like others. An empty table gives none. Columns
    named n_lines or n_dropped are replaced, other names can't clash.
    """
    keys = staged(boilerplate_lines(docs, host_col, text_col, ratio, min_pages, fold_copies).select("host", "key"), "boilerplate")
    of, bad, kept, salt, part = fresh(docs, "of", "bad", "kept", "salt", "part")
    lists = keys.groupBy("host").agg(F.collect_list("key").alias(bad)).withColumnRenamed("host", of)
    here = F.col(host_col).eqNullSafe(F.col(of))
    if keys.count() <= BROADCAST_ROWS:
        joined = docs.join(F.broadcast(lists), here, "left")
    else:
        lists = lists.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        dealt = docs.withColumn(salt, F.pmod(F.xxhash64(F.col(text_col)), F.lit(SALT)).cast("int"))
        joined = dealt.join(lists, here & (F.col(salt) == F.col(part)), "left").drop(salt, part)
    lines = F.split(F.col(text_col), "\n")
    rest = F.filter(lines, lambda x: ~F.array_contains(bad, _key(F.col(host_col), F.trim(x))))
    out = joined.withColumn(kept, F.when(F.col(bad).isNotNull() & F.col(text_col).isNotNull(), rest))
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    n_dropped = F.when(F.col(kept).isNull(), F.lit(0)).otherwise(n_lines - F.size(kept)).cast("long")
    text = F.when(F.col(kept).isNull() | (n_dropped == 0), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped") or c == text_col]
    return out.select(*columns, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


SQL = f"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
totals AS (SELECT source, count(*) AS host_pages FROM pages WHERE text IS NOT NULL GROUP BY source),
lines AS (SELECT source, unnest(list_distinct(list_transform(ls, lambda x: trim(x, ' ')))) AS line FROM pages),
counts AS (SELECT source, line, count(*) AS n_pages FROM lines WHERE line <> '' GROUP BY source, line),
bad AS (
  SELECT c.source, c.line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE n_pages >= {MIN_PAGES} AND n_pages > {RATIO} * host_pages),
numbered AS (SELECT row_number() OVER () AS r, * FROM pages),
each AS (SELECT r, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM numbered),
kept AS (
  SELECT r, string_agg(e.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL) AS text, count(b.line) AS n_dropped
  FROM each e LEFT JOIN bad b ON e.source IS NOT DISTINCT FROM b.source AND trim(e.line, ' ') = b.line GROUP BY r)
SELECT n.doc_id, CAST(coalesce(len(n.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_dropped, 0) AS BIGINT) AS n_dropped,
  CASE WHEN n.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM numbered n LEFT JOIN kept k ON n.r = k.r
"""
