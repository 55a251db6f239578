"""Incremental runs as streams: new files, content dedup, exactly-once staging, change feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import field_changes

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, root: str, per_batch: int = 1000) -> DataFrame:
    """A stream of files with their fingerprints; the query's checkpoint remembers which have been seen."""
    files = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_batch).load(root)
    return files.where(F.lower("path").rlike(r"\.(xlsx|xls|csv)$")).withColumn("content_hash", F.sha2("content", 256))


def once_by_content(files: DataFrame, within: str | None = None, at: str = "modificationTime") -> DataFrame:
    """Each content once; with ``within`` the state of older contents is dropped."""
    if within:
        return files.withWatermark(at, within).dropDuplicatesWithinWatermark(["content_hash"])
    return files.dropDuplicates(["content_hash"])


def run_available(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """S3: process what is there in micro-batches and stop. A batch that is run again has the same number, so a sink that
    writes batch n to a place of its own stays exactly-once."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each_batch).start()


def stage_then_ledger(parse: Callable[[DataFrame], DataFrame], staged_path: str, ledger_path: str) -> Callable[[DataFrame, int], None]:
    """S3: the batch's rows first, then its hashes: a crash in between repeats rows of one batch folder, and loses none."""

    def write(batch: DataFrame, number: int) -> None:
        parse(batch).write.mode("overwrite").parquet(f"{staged_path}/batch={number}")
        batch.select("path", "content_hash").write.mode("overwrite").parquet(f"{ledger_path}/batch={number}")

    return write


def change_feed(baseline: DataFrame, key: str, fields: list[str], out_path: str) -> Callable[[DataFrame, int], None]:
    """For each batch of current records, the fields that differ from the baseline."""

    def write(batch: DataFrame, number: int) -> None:
        field_changes(baseline, batch, key, fields).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return write


def windowed_counts(events: DataFrame, at: str, size: str, late: str, *by: str) -> DataFrame:
    """Counts by event-time window with a bound on lateness."""
    return events.withWatermark(at, late).groupBy(F.window(at, size), *by).count()
