"""Records of online tables and snapshots, and the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import strip
from ..registry import COLUMNS, SINK_NAMES, registry_schema


def unwrap_value(json: Column) -> Column:
    """The text inside [{"text": v}] or {"text": v}, else the value as it is."""
    return F.coalesce(F.get_json_object(json, "$[0].text"), F.when(json.startswith("{"), F.get_json_object(json, "$.text")), json)


def flatten_records(records: DataFrame) -> DataFrame:
    """(record_id, fields map<string,string>) from (record_id, fields_json): every value unwrapped."""
    pairs = F.from_json("fields_json", "map<string,string>")
    return records.select("record_id", F.transform_values(pairs, lambda k, v: unwrap_value(v)).alias("fields"))


META = ("record_id", "created_time", "last_modified_time", "created_by", "last_modified_by")


def hoist_metadata(records: DataFrame) -> DataFrame:
    """(row map<string,string>) with the metadata and all fields at one level; fields win on a clash."""
    meta = F.map_from_arrays(F.array(*map(F.lit, META)), F.array(*[F.col(m).cast("string") for m in META]))
    kept = F.map_filter(meta, lambda k, v: ~F.array_contains(F.map_keys("fields"), k))
    return records.select(F.map_concat(kept, "fields").alias("row"))


def dimension_index(records: DataFrame) -> DataFrame:
    """(brand, model, id) with brand '' for the model alone; the last record (by ord) wins; lower case."""
    low = lambda c: F.lower(strip(F.coalesce(F.col(c), F.lit(""))))
    rows = records.select(low("brand").alias("brand"), low("model").alias("model"), strip(F.coalesce(F.col("model_id"), F.lit(""))).alias("id"), "ord").where("model <> '' and id <> ''")
    keyed = rows.where("brand <> ''").unionByName(rows.withColumn("brand", F.lit("")))
    return keyed.groupBy("brand", "model").agg(F.max_by("id", "ord").alias("id"))


def variant_index(records: DataFrame) -> DataFrame:
    """(model_id, variant, id, prio) from records with variant or trim_config and one of three ids."""
    given = lambda *cs: F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in cs], F.lit(""))
    rows = records.select(strip(given("model_id")).alias("model_id"), F.lower(strip(given("variant", "trim_config"))).alias("variant"), strip(given("trim_config_id", "variant_id", "record_id")).alias("id"), "ord")
    rows = rows.where("model_id <> '' and variant <> '' and id <> ''")
    return rows.groupBy("model_id", "variant").agg(F.max_by("id", "ord").alias("id"), F.min("ord").alias("prio"))


def sink_payload(rows: DataFrame) -> DataFrame:
    """(id, record): JSON of the allowed sink columns under their sink names; null and "" are left out."""
    cols = [F.col(c).cast(registry_schema()[c].dataType).alias(SINK_NAMES[c]) for c in COLUMNS if SINK_NAMES[c] in fixed.SINK_ALLOWED and c in rows.columns]
    if "source_file" in rows.columns:
        cols.append(F.col("source_file").alias("素材源文件路径"))
    if "sync_batch_id" in rows.columns:
        cols.append(F.col("sync_batch_id"))
    named = rows.select("id", *cols)
    given = [F.when(F.col(f"`{c}`").cast("string") != "", F.col(f"`{c}`")).alias(c) for c in named.columns if c != "id"]
    return named.select("id", F.to_json(F.struct(*given)).alias("record"))


def composite_payload(rows: DataFrame) -> DataFrame:
    """(id, record): the name 'supplier brand model variant' leads the notes; the version is an array."""
    name = F.trim(F.regexp_replace(F.concat_ws(" ", "supplier", "brand", "model", "variant"), " +", " "))
    notes = F.concat_ws(" | ", F.when(name != "", name), F.when(F.col("notes") != "", F.col("notes")))
    fields = F.struct(
        *[F.when(F.col(c).cast("string") != "", F.col(c)).alias(c) for c in ("brand", "model", "variant", "exterior_color", "interior_color", "location", "cost_exw_usd", "cost_fob_usd", "cost_fca_usd")],
        F.when(F.col("version_type") != "", F.array("version_type")).alias("version_type"),
        notes.alias("notes"),
    )
    return rows.select("id", F.to_json(fields).alias("record"))


def write_json(rows: DataFrame, path: str) -> None:
    """Candidates as JSON lines, replaced as a whole."""
    rows.write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """The registry's columns in registry order, with a header; other columns are left out."""
    present = [F.col(c) if c in rows.columns else F.lit(None).cast(registry_schema()[c].dataType).alias(c) for c in COLUMNS]
    rows.select(*present).write.mode("overwrite").option("header", True).csv(path)


def write_by_source(rows: DataFrame, path: str, source: str = "source_file") -> None:
    """One folder of JSON for each source."""
    rows.write.mode("overwrite").partitionBy(source).json(path)


def read_json_array(spark: SparkSession, path: str, schema) -> DataFrame:
    """Candidates from files that hold one JSON array each, or JSON lines; the first written line tells which."""
    first = spark.read.text(path).where(F.trim("value") != "").select(F.ltrim("value").startswith("[")).first()
    return spark.read.schema(schema).option("multiLine", bool(first and first[0])).json(path)


def templates(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """An empty row of the registry, and its column descriptions."""
    empty = spark.createDataFrame([tuple([None] * len(COLUMNS))], registry_schema())
    return empty, spark.createDataFrame([(f[0], f[1], f[3]) for f in fixed.FIELDS], "column string, sink_name string, kind string")


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The rows of the newest snapshot."""
    newest = snapshots.agg(F.max("snapshot_ts").alias("snapshot_ts"))
    return snapshots.join(F.broadcast(newest), "snapshot_ts")
