"""What several of the training-data operators need: shared storage, table reading, byte-level words."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session, whose executors share the driver's disk, may leave
    it unset: it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    The written table cuts the lineage, is computed one time however often it is read, and outlives a lost executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallyforge-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a table made by ``staged`` that no later step reads."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tallyforge-" in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names after ``names`` that ``df`` does not use, whatever the case of its letters."""
    used = {c.lower() for c in df.columns}
    mark = "__"
    while any(f"{mark}{n}".lower() in used for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def held_out(id_col: str, folds: int) -> Column:
    """True for rows whose crc32 of the id as text is divisible by ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, b"" for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def each_text(column: pa.Array, at_once: int = 256):
    """The texts of ``text_bytes`` one by one, so that a task never holds a whole batch of them as Python objects beside the
    batch itself. What Arrow has set aside goes back to the system after each batch."""
    plain = column.cast(pa.binary())
    for lo in range(0, len(plain), at_once):
        yield from (x or b"" for x in plain.slice(lo, at_once).to_pylist())
    pa.default_memory_pool().release_unused()


def lower_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only: bytes.lower and bytes.split do just that."""
    return text.lower().split()


def group_bounds(*keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal keys in sorted arrays, with the length appended."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, np.int64)
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)


def whole_groups(batches, keys: list[str]):
    """Re-cut a sorted stream of Arrow batches so that no run of equal keys is split between two of them."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if table.num_rows == 0:
            continue
        last = group_bounds(*(table.column(k).to_numpy() for k in keys))[-2]
        if last == 0:
            rest = table
            continue
        yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest


#: Rows of a few numbers each up to which a table is sent to every task; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000


def for_join(df: DataFrame, label: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table, written out, counted, and marked for broadcast only if it has at most ``most`` rows."""
    table = staged(df, label)
    return F.broadcast(table) if table.count() <= most else table
