"""The staged table: append, edit, delete, transitions, batches, ledger. Mutations are whole-table plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..materialize import written
from ..registry import EDITABLE, registry_schema


def with_ids(rows: DataFrame, start: int, order: list[str] | None = None) -> DataFrame:
    """Rows with consecutive ids after ``start``, in the order of ``order`` if given.

    Rows are tagged with their partition and place and written once, so that counts and rows agree; partitions are then offset
    by the counts before them. No window spans the table; with ``order`` the partitions are ranges of it.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
    tagged = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    parts = written(tagged, "numbered")
    counts = parts.groupBy("_part").count()
    offsets = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))  # one row for each partition
    return parts.join(F.broadcast(offsets), "_part").withColumn("id", (F.col("_before") + F.col("_seq") + start + 1).cast("long")).drop("_part", "_seq", "_before")


def stage(candidates: DataFrame, start: int, created_at: Column, order: list[str] | None = None) -> DataFrame:
    """G1: the registry's columns with id, status 'pending', source_file, content_hash, created_at."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in candidates.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in registry_schema()]
    extra = [F.col(c) if c in candidates.columns else F.lit(None).cast("string").alias(c) for c in ("source_file", "content_hash")]
    ranks = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order or ())]
    rows = candidates.select(*fields, F.lit("pending").alias("status"), *extra, created_at.alias("created_at"), *ranks)
    return with_ids(rows, start, [f"_o{i}" for i in range(len(ranks))]).select("id", *[c for c in rows.columns if not c.startswith("_o")])


PENDING = ("id", "supplier", "brand", "model", "variant", "exterior_color", "interior_color", "supplier_price_cny", "cost_exw_usd", "cost_fob_usd", "location", "status", "source_file")


def pending(staged: DataFrame, columns: tuple[str, ...] = PENDING) -> DataFrame:
    """Pending rows in a fixed projection; absent columns are null."""
    return staged.where("status = 'pending'").select(*[F.col(c) if c in staged.columns else F.lit(None).cast("string").alias(c) for c in columns])


def split_edits(edits: DataFrame, allowed: tuple[str, ...] = EDITABLE) -> tuple[DataFrame, DataFrame]:
    """V6: (edits of known keys, rejected edits)."""
    return edits.where(F.col("key").isin(*allowed)), edits.where(~F.coalesce(F.col("key").isin(*allowed), F.lit(False)))


def apply_edits(table: DataFrame, edits: DataFrame, id_col: str = "id") -> DataFrame:
    """``table`` with edits (id, key, value[, ord]) applied; of several edits of one field the last (by ord) wins.

    An edit's value may be null, which clears the field. Edits of unknown keys must be split off before.
    """
    kinds = {c: k for c, k in table.dtypes if c != id_col}
    last = F.struct(F.max_by("value", "ord" if "ord" in edits.columns else F.lit(0)).alias("value"))
    one = edits.groupBy(F.col("id").alias(id_col), "key").agg(last.alias("e"))
    wide = one.groupBy(id_col).pivot("key", list(kinds)).agg(F.first("e"))
    wide = wide.select(id_col, *[F.col(f"`{c}`").alias(f"_e_{c}") for c in kinds])
    joined = table.join(wide, id_col, "left")
    out = [F.when(F.col(f"_e_{c}").isNotNull(), F.col(f"_e_{c}.value").try_cast(k)).otherwise(F.col(c)).alias(c) for c, k in kinds.items()]
    return joined.select(id_col, *out).select(*table.columns)


def old_values(table: DataFrame, edits: DataFrame, id_col: str = "id") -> DataFrame:
    """The value that each edit replaces, for rule distillation: (id, key, old_value, value[, ord]). With ``ord``, an edit that
    follows another of the same field replaces that one's value."""
    kinds = [c for c in table.columns if c != id_col]
    long = table.select(F.col(id_col).alias("id"), *[F.col(c).cast("string").alias(c) for c in kinds]).unpivot("id", kinds, "key", "old_value")
    found = edits.join(long, ["id", "key"])
    if "ord" not in edits.columns:
        return found.select("id", "key", "old_value", "value")
    w = Window.partitionBy("id", "key").orderBy("ord")
    before = F.when(F.row_number().over(w) == 1, F.col("old_value")).otherwise(F.lag("value").over(w))
    return found.select("id", "key", before.alias("old_value"), "value", "ord")


def delete_rows(table: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """G3"""
    return table.join(ids.select(id_col), id_col, "left_anti")


def transition(table: DataFrame, ids: DataFrame, to: str = "synced", id_col: str = "id") -> DataFrame:
    """The status of the given ids changes."""
    hit = ids.select(F.col(id_col).alias("_hit")).distinct()
    joined = table.join(hit, table[id_col] == F.col("_hit"), "left")
    return joined.withColumn("status", F.when(F.col("_hit").isNotNull(), to).otherwise(F.col("status"))).drop("_hit")


def batch_id(at: Column) -> Column:
    """yyyyMMdd_HHmmss."""
    return F.date_format(at, "yyyyMMdd_HHmmss")


def batches(rows: DataFrame, size: int, id_col: str = "id") -> DataFrame:
    """with batch_no, for consecutive ids from 1 on (see ``with_ids``)."""
    return rows.withColumn("batch_no", F.floor((F.col(id_col) - 1) / size).cast("long"))


def ledger_rows(files: DataFrame, ledger: DataFrame, at: Column) -> DataFrame:
    """Ledger rows (filename, content_hash, processed_at) to append after staging succeeded: unseen hashes, once each."""
    new = files.groupBy("content_hash").agg(F.min(F.regexp_extract("path", r"([^/]*)$", 1)).alias("filename"))
    return new.join(ledger.select("content_hash"), "content_hash", "left_anti").select("filename", "content_hash", at.alias("processed_at"))


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both, columns that one side lacks as null."""
    return old.unionByName(new, allowMissingColumns=True)


def check_target(name: str, protected: tuple[str, ...]) -> None:
    """V7: refuse to write to a read-only table."""
    if name in protected:
        raise PermissionError(f"{name} is read-only")
