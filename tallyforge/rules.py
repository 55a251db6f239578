"""Rule tables as DataFrames, with their order in ``prio``; built in, or read from a JSON rules file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed
from .operators.staging import with_ids


def built_in_brand_models() -> list[tuple[str, str, str, str]]:
    rows = [(raw_brand.lower(), raw_model.lower(), brand, model) for raw_brand, raw_model, brand, model in fixed.BRAND_MODELS]
    places: dict[tuple[str, str], tuple[str, str]] = {}
    for rb, rm, b, m in rows:  # a later line overwrites the value and keeps the place
        places[rb, rm] = (b, m)
    return [(*k, *v) for k, v in places.items()]


def brand_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *r) for i, r in enumerate(fixed.BRAND_NAMES)], "prio int, zh string, en string")


def brand_models(spark: SparkSession, override: DataFrame | None = None) -> DataFrame:
    """(prio, raw_brand, raw_model, brand, model), each prio once. Rows of ``override`` (raw_brand, raw_model, brand,
    model[, ord]) with a raw brand, a brand and a model win over built-in rows of the same key, which keep their place; new
    keys follow in their order (by ord, else by key), and the last of several rows of a key wins."""
    base = spark.createDataFrame([(i, 0, *r) for i, r in enumerate(built_in_brand_models())], "prio long, rank int, raw_brand string, raw_model string, brand string, model string")
    if override is None:
        return base.drop("rank")
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    more = override.select(F.lit(1).alias("rank"), F.lower(t("raw_brand")).alias("raw_brand"), F.lower(t("raw_model")).alias("raw_model"), t("brand").alias("brand"), t("model").alias("model"), (F.col("ord").cast("long") if "ord" in override.columns else F.lit(0)).alias("ord"))
    more = more.where("raw_brand <> '' and brand <> '' and model <> ''")
    more = with_ids(more, len(fixed.BRAND_MODELS), ["ord", "raw_brand", "raw_model", "brand", "model"]).withColumnRenamed("id", "prio").drop("ord")
    both = base.unionByName(more).groupBy("raw_brand", "raw_model").agg(F.min("prio").alias("prio"), F.max_by(F.struct("brand", "model"), F.struct("rank", "prio")).alias("v"))
    return both.select("prio", "raw_brand", "raw_model", "v.brand", "v.model")


#: Where learned header rules and the aliases behind them begin in the order of ``header_rules``.
LEARNED, BEHIND = 1 << 20, 1 << 62


def header_rules(spark: SparkSession, learned: DataFrame | None = None) -> DataFrame:
    """B1: (prio, kind, pattern, field), kind 'equals' or 'contains': names, then learned rules (prio below 2^61, pattern, field), then aliases, then the
    registry."""
    rows = [("equals", f.lower(), f) for f, _ in fixed.HEADER_ALIASES]
    tail = [("contains", a.lower(), f) for f, aliases in fixed.HEADER_ALIASES for a in aliases]
    registry: dict[str, str] = {}
    for _, _, name, _, aliases in fixed.FIELDS:
        registry |= {a.lower(): name for a in aliases}
    tail += [("contains", a, f) for a, f in registry.items()]
    schema = "prio long, kind string, pattern string, field string"
    first = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    last = spark.createDataFrame([(BEHIND + i, *r) for i, r in enumerate(tail)], schema)
    if learned is None:
        return first.unionByName(last)
    middle = learned.select((F.lit(LEARNED) + F.col("prio").cast("long")).alias("prio"), F.lit("contains").alias("kind"), "pattern", "field")
    return first.unionByName(middle).unionByName(last)


def code_prefixes(spark: SparkSession) -> DataFrame:
    rows = [(i, "prefix", *r) for i, r in enumerate((*fixed.CODE_PREFIXES,))] + [(1000 + i, "equals", *r) for i, r in enumerate(fixed.CODE_EXACT)]
    return spark.createDataFrame(rows, "prio int, kind string, code string, name string")


def places(spark: SparkSession) -> DataFrame:
    """Longest key first, then list order."""
    ranked = sorted(fixed.LOCATIONS, key=lambda p: -len(p[0]))
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ranked)], "prio int, key string, canonical string")


def valid_brands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(b,) for b in fixed.VALID_BRANDS], "brand string")


def load_rules(spark: SparkSession, path: str, family: str, fallback: DataFrame) -> DataFrame:
    """A10: a family of string-to-string rules (prio, key, value) out of a JSON rules object, or ``fallback`` where the file
    is missing or holds no such family."""
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True)
        keys = F.expr(f"json_object_keys(get_json_object(value, '$.{family}'))")
        pairs = F.from_json(F.get_json_object("value", f"$.{family}"), "map<string,string>")
        rows = text.select(F.posexplode(keys).alias("prio", "key"), pairs.alias("m")).select("prio", "key", F.element_at("m", F.col("key")).alias("value"))
        return rows if rows.limit(1).count() else fallback
    except AnalysisException:
        return fallback
