"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, drop_staged, fresh, staged

MAX_EPOCHS = 3
CYCLE = (5, 2, 1)
#: Hex digits of the seeded hash that each step of the search for the cut adds: 4096 buckets a source.
PREFIX = 3


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: float = MAX_EPOCHS, cycle: tuple[int, ...] = CYCLE, budget: float = 1.0) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources in code-point order, null last, take the weights of ``cycle`` in turn and share ``budget`` times all sizes. A
    target stops at ``max_epochs`` times its source's size; the excess is shared by weight among the others until none is
    above. That fixed point needs no loop: sources by rising cap per weight are full one after another for as long as a
    source's cap is at most its share of what those before it leave. Works on one row per source, not on documents.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(x) for x in cycle])
    ranked = sources.withColumn("weight", F.element_at(weights, ((F.row_number().over(w) - 1) % len(cycle) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    laid = ranked.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights_left"),
    )
    laid = laid.withColumn("full", F.col("cap") * F.col("weights_left") <= F.col("left") * F.col("weight"))
    # the first source that isn't full sets the level for itself and all that follow
    laid = laid.withColumn("open_from", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "source", "left", "weights_left"))).over(everything))
    share = F.col("weight") * F.col("open_from.left") / F.col("open_from.weights_left")
    return laid.select("source", "source_size", "weight", F.when(F.col("full") | F.col("open_from").isNull(), F.col("cap")).otherwise(share).alias("target"))


def seeded_order(id_: Column, text: Column, seed: str) -> Column:
    """A hex string that orders rows at random, the same in every run."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def _edge(rows: DataFrame, marks: DataFrame, digits: int) -> DataFrame:
    """From marks (key, extra, start, prefix): the bucket of ``digits`` hex digits below each prefix in which the extra words
    of a source run out, as marks again. At most 4096 sums of a source are put in order."""
    inside = rows.join(marks, (F.struct("source") == marks["key"]) & F.startswith("h", F.col("prefix")))
    sums = inside.groupBy("key", F.substring("h", 1, digits).alias("bucket")).agg(F.sum("size").alias("size"), F.first("extra").alias("extra"), F.first("start").alias("start"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    return sums.where("start <= extra and extra < start + size").select("key", "extra", "start", F.col("bucket").alias("prefix"))


def repetition_plan(rows: DataFrame, max_epochs: float = MAX_EPOCHS, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(source, source_size, target, whole, cut, quota, equal) from rows (source, size, h).

    All of a source is taken ``whole`` times; rows whose h is below ``cut`` are taken once more, and ``quota`` of the
    ``equal`` rows that share the h of the cut, which comes as near to the target as whole rows can. The cut is found by
    sums over the first 3, then 6 hex digits of h; only what shares 6 digits with it is put in order, so no source is sorted.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(sizes, max_epochs, cycle)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = staged(targets.withColumn("key", F.struct("source")), "mix-targets")
    marks = targets.where("whole < " + str(float(max_epochs))).select("key", "extra", F.lit(0).cast("long").alias("start"), F.lit("").alias("prefix"))
    for digits in (PREFIX, 2 * PREFIX):
        marks = staged(_edge(rows, F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks, digits), "mix-edges")
    near = rows.join(marks, (F.struct("source") == marks["key"]) & F.startswith("h", F.col("prefix"))).groupBy("key", "h").agg(F.max("size").alias("size"), F.count("*").alias("equal"), F.first("extra").alias("extra"), F.first("start").alias("start"))
    before = Window.partitionBy("key").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("start", F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("equal")).over(before), F.lit(0)))
    fit = F.floor((F.col("extra") - F.col("start")) / F.col("size") + 0.5).cast("long")
    fit = F.when(F.col("size") == 0, F.when(F.col("start") <= F.col("extra"), F.col("equal")).otherwise(0)).otherwise(F.least(F.greatest(fit, F.lit(0)), "equal"))
    cuts = near.withColumn("quota", fit.cast("long")).where("quota > 0").groupBy("key").agg(F.max(F.struct("h", "quota", "equal")).alias("last"))
    cuts = cuts.join(marks.select("key", "prefix"), "key", "right").select("key", F.coalesce("last.h", "prefix").alias("cut"), F.coalesce("last.quota", F.lit(0)).alias("quota"), F.coalesce("last.equal", F.lit(0)).alias("equal"))
    return targets.join(cuts, "key", "left").select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut"), F.coalesce("quota", F.lit(0).cast("long")).alias("quota"), F.coalesce("equal", F.lit(0).cast("long")).alias("equal"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_epochs: float = MAX_EPOCHS, cycle: tuple[int, ...] = CYCLE, seed: str = "mix-1") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (= copies x size).

    Documents stand in the order of a seeded hash of id and text. A source is taken whole floor(target / size) times, and
    its first documents in that order once more up to the target. Which documents those are depends on the source and the
    hash alone, so reruns and other partitionings agree, and documents are only joined to one row per source.
    Null text: size 0, taken 0. A null source is a source of its own, last in order. Rows equal in id and text are
    interchangeable: where the cut falls among them, as many are taken as fit. Columns of ``docs`` named like a result are
    replaced, other names can't clash.
    """
    order = seeded_order(F.col(id_col), F.col(text_col), seed)
    rows = staged(docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), order.alias("h")), "mix-rows")
    plan = staged(repetition_plan(rows, max_epochs, cycle), "mix-plan")
    drop_staged(rows)
    results = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in docs.columns if c not in results or c in (id_col, text_col, source_col)]
    h, size, src, whole, cut, quota, equal, goal, all_, salt, nth, h2, s2, p2, share = fresh(docs, "h", "size", "src", "whole", "cut", "quota", "equal", "goal", "all", "salt", "nth", "h2", "s2", "p2", "share")
    plan = plan.select(*[F.col(a).alias(b) for a, b in (("source", src), ("source_size", all_), ("target", goal), ("whole", whole), ("cut", cut), ("quota", quota), ("equal", equal))])
    split = plan.where(F.col(quota) < F.col(equal)).limit(1).count() > 0
    out = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(size, word_count(F.col(text_col))).withColumn(h, order)
    out = out.join(F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan, F.col(source_col).eqNullSafe(F.col(src)))
    first = F.col(h) <= F.col(cut)
    if split:  # some of several equal rows: shares of the quota by where the rows were written, then by number there
        tied = (F.col(h) == F.col(cut)) & (F.col(quota) < F.col(equal))
        edge = staged(out.where(tied).withColumn(salt, F.spark_partition_id()), "mix-ties")
        upto = Window.partitionBy(h, src).orderBy(salt).rowsBetween(Window.unboundedPreceding, 0)
        n, all_before = F.col("n"), F.col("upto") - F.col("n")
        shares = edge.groupBy(h, src, salt).agg(F.count("*").alias("n"), F.first(quota).alias("q")).withColumn("upto", F.sum("n").over(upto))
        shares = shares.select(F.col(h).alias(h2), F.col(src).alias(s2), F.col(salt).alias(p2), F.least(n, F.greatest(F.lit(0), F.col("q") - all_before)).alias(share))
        edge = edge.withColumn(nth, F.row_number().over(Window.partitionBy(h, src, salt).orderBy(h)))
        edge = edge.join(F.broadcast(shares) if shares.count() <= BROADCAST_ROWS else shares, (F.col(h) == F.col(h2)) & F.col(src).eqNullSafe(F.col(s2)) & (F.col(salt) == F.col(p2)))
        parts = [(out.where(~tied), first), (edge, F.col(nth) <= F.col(share))]
    else:
        parts = [(out, first)]
    done = None
    for part, again in parts:
        copies = (F.col(whole) + F.when(again & (F.col(whole) < F.lit(float(max_epochs))), 1).otherwise(0)).cast("long")
        part = part.select(*[F.col(f"`{c}`") for c in kept if c not in results], *[F.col(f"`{c}`") for c in kept if c in results], F.col(size).alias("size"), F.col(all_).alias("source_size"), F.col(goal).alias("target"), copies.alias("copies"), (copies * F.col(size)).alias("taken"))
        done = part if done is None else done.unionByName(part)
    return done


SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5(concat_ws('|', 'mix-1', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [{", ".join(map(str, CYCLE))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(CYCLE)} + 1)::INT] AS weight, {float(MAX_EPOCHS)}::DOUBLE * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER b, 0) AS remaining, (sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER b, 0)::BIGINT AS weights_left
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * weights_left <= remaining * weight AS is_full FROM l),
o AS (SELECT remaining, weights_left FROM f WHERE NOT is_full ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN is_full OR NOT EXISTS (SELECT * FROM o) THEN cap ELSE weight * (SELECT remaining FROM o) / (SELECT weights_left FROM o) END AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
c AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS extra,
    sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN whole < {MAX_EPOCHS} AND 2 * upto - size <= 2 * extra THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
