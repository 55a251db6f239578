"""Snapshots, change feeds, learned rules, telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import comparable, strip


def build_snapshot(records: DataFrame, key: str = "record_id", order: str = "ord") -> DataFrame:
    """One row per record id, the last by ``order``."""
    rest = [c for c in records.columns if c not in (key, order)]
    return records.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def field_changes(baseline: DataFrame, current: DataFrame, key: str, fields: list[str], context: list[str] = ()) -> DataFrame:
    """(key, field, old_value, new_value, context...) of every field that differs between two versions of a record.

    Values are compared as trimmed text, blank as null. Records join once, wide; only changed fields become rows.
    """
    b = baseline.select(F.col(key), *[comparable(F.col(f)).alias(f"_b_{f}") for f in fields])
    both = current.select(F.col(key), *[comparable(F.col(f)).alias(f"_c_{f}") for f in fields], *[F.col(c).alias(f"_x_{c}") for c in context]).join(b, key)
    each = F.array(*[F.when(~F.col(f"_b_{f}").eqNullSafe(F.col(f"_c_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"_b_{f}").alias("old_value"), F.col(f"_c_{f}").alias("new_value"))) for f in fields])
    out = both.select(key, F.explode(F.array_compact(each)).alias("c"), *[F.col(f"_x_{c}").alias(c) for c in context])
    return out.select(key, "c.field", "c.old_value", "c.new_value", *context)


def harvest(baseline: DataFrame, current: DataFrame, approved: Column, key: str = "record_id", fields=fixed.COMPARED_FIELDS) -> DataFrame:
    """G6 on approved records: the change feed with supplier, brand, model, and whether a rule can be distilled."""
    present = [f for f in fields if f in current.columns and f in baseline.columns]
    context = [c for c in ("supplier", "brand", "model") if c in current.columns]
    changes = field_changes(baseline, current.where(approved), key, present, context)
    return changes.withColumn("rule_distilled", F.col("new_value").isNotNull())


def harvest_counts(current: DataFrame, approved: Column, by: list[str] = ()) -> DataFrame:
    """Scanned, approved, skipped."""
    return current.groupBy(*by).agg(F.count("*").alias("scanned"), F.count_if(approved).alias("approved"), F.count_if(~approved).alias("skipped"))


def changes_by_record(changes: DataFrame, key: str = "record_id") -> DataFrame:
    """E5: the changes of each record, their number and how many were distilled."""
    return changes.groupBy(key).agg(F.count("*").alias("n_changes"), F.count_if("rule_distilled").alias("n_distilled"), F.array_sort(F.collect_list(F.struct("field", "old_value", "new_value"))).alias("changes"))


RULE = ["type", "field", "raw_pattern"]


def distil(edits: DataFrame) -> DataFrame:
    """Rules (type, field, raw_pattern, target_value, context, ord) from edits (field, old_value, new_value, context, ord)."""
    rows = edits.where("field <> '' and new_value is not null")
    return rows.select(F.lit("field_override").alias("type"), "field", strip(F.coalesce("old_value", F.lit(""))).alias("raw_pattern"), F.col("new_value").alias("target_value"), F.coalesce("context", F.lit("cli_edit")).alias("context"), "ord")


def upsert_rules(rules: DataFrame, new: DataFrame) -> DataFrame:
    """Of each (type, field, raw_pattern) the last target and the first context and place."""
    return rules.unionByName(new).groupBy(*RULE).agg(F.max_by("target_value", "ord").alias("target_value"), F.min_by("context", "ord").alias("context"), F.min("ord").alias("ord"))


def apply_overrides(rows: DataFrame, rules: DataFrame, fields: list[str]) -> DataFrame:
    """Learned overrides applied: a field whose trimmed value equals a rule's pattern takes the rule's target. Fields without a
    rule cost nothing; a blank pattern never applies, or every missing value would take its target."""
    used = rules.where((F.col("type") == "field_override") & (F.col("raw_pattern") != "") & F.col("field").isin(*fields))
    named = {r[0] for r in used.select("field").distinct().collect()}  # at most the fields
    out = rows
    for f in [f for f in fields if f in named]:
        r = used.where(F.col("field") == f).groupBy(F.col("raw_pattern").alias("_p")).agg(F.max_by("target_value", "ord").alias("_t"))
        kind = dict(rows.dtypes)[f]
        out = out.join(r, strip(F.col(f).cast("string")) == F.col("_p"), "left").withColumn(f, F.coalesce(F.col("_t").try_cast(kind), F.col(f))).drop("_p", "_t")
    return out


def telemetry(runs: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Totals and shares over run metrics (deterministic, ai); 100 % and 0 % without any. With ``rules`` also their number."""
    t = runs.agg(F.count("*").alias("total_runs"), F.coalesce(F.sum("deterministic"), F.lit(0)).cast("long").alias("deterministic_hits"), F.coalesce(F.sum("ai"), F.lit(0)).cast("long").alias("ai_fallbacks"))
    total = F.col("deterministic_hits") + F.col("ai_fallbacks")
    share = lambda c, none: F.when(total == 0, F.lit(none)).otherwise(F.round(F.col(c) / total * 100.0, 1))
    if rules is not None:
        t = t.crossJoin(F.broadcast(rules.agg(F.count("*").alias("learned_rules"))))  # one row each
    return t.select("*", total.alias("total"), share("deterministic_hits", 100.0).alias("deterministic_pct"), share("ai_fallbacks", 0.0).alias("ai_pct"))
