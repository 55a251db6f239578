"""Files as tables: discovery, fingerprints, CSV and workbook cells, text documents."""

from __future__ import annotations

import csv
import io
import tempfile
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workbooks import workbook_cells

CELLS = "path string, content_hash string, sheet string, sheet_no int, row_no int, col_no int, value string, kind string, merged boolean, error string"
#: Cells that are handed to Arrow at once.
CHUNK = 20_000
#: Bytes of a file's cells, compressed, that are held in memory until its end is read; more go to a scratch file.
HELD = 1 << 23


def discover(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("xlsx", "xls", "csv")) -> DataFrame:
    """A1, A2: (path, content_hash, length, content) of the files below ``root`` with one of the suffixes, any case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return fingerprinted(files.where(F.lower("path").rlike(rf"\.({'|'.join(suffixes)})$")))


def fingerprinted(files: DataFrame) -> DataFrame:
    """A2: with the SHA-256 of the content."""
    return files.select("path", F.sha2("content", 256).alias("content_hash"), "length", "content")


def unseen(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content is not in the ledger (content_hash)."""
    return files.join(ledger.select("content_hash").distinct(), "content_hash", "left_anti")


def _csv_cells(data: bytes):
    rows = csv.reader(io.StringIO(data.decode("utf-8-sig", errors="ignore"), newline=None))  # line ends inside quotes are \n too
    n = 0
    for row in rows:
        if any(row):
            n += 1
            for c, value in enumerate(row, 1):
                yield "Sheet1", 1, n, c, value, "s", False


def read_cells(files: DataFrame) -> DataFrame:
    """One row per cell of CSV files and workbooks; a file that can't be decoded gives one row with ``error``, and no
    cells.

    Kinds: 's' text, 'n' number, 'd' date and time (ISO), 't' time or duration, 'b' boolean. CSV is UTF-8, undecodable bytes
    dropped, one sheet named Sheet1. Old binary workbooks are not decodable. Files are independent, so decoding is spread over
    tasks; one file's cells stay in one task, compressed and beyond ``HELD`` bytes in a scratch file, until its end is read.
    """

    def table(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types[2:-1])], names[2:-1])

    def whole(path, digest, held) -> pa.RecordBatch:
        n = held.num_rows
        same = [pa.repeat(pa.scalar(x, pa.string()), n) for x in (path, digest, None)]
        return pa.RecordBatch.from_arrays([*same[:2], *held.columns, same[2]], names)

    def run(batches):
        kinds = pa.schema(list(zip(names[2:-1], types[2:-1])))
        packed = pa.ipc.IpcWriteOptions(compression="lz4")
        for batch in batches:
            for path, digest, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                with tempfile.SpooledTemporaryFile(HELD) as done:
                    try:
                        cells = (_csv_cells if path.lower().endswith(".csv") else workbook_cells)(data.as_py())
                        with pa.ipc.new_stream(done, kinds, options=packed) as out:
                            while chunk := list(islice(cells, CHUNK)):
                                out.write_batch(table(chunk))
                    except Exception as e:  # any damage in a file is that file's error
                        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([path, digest, *[None] * 7, f"{type(e).__name__}: {e}"], types)], names)
                    else:
                        done.seek(0)
                        for held in pa.ipc.open_stream(done):
                            yield whole(path, digest, held)

    names = [c.split()[0] for c in CELLS.split(", ")]
    types = [{"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]] for c in CELLS.split(", ")]
    return files.select("path", "content_hash", "content").mapInArrow(run, CELLS)


def split_errors(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good cells, (path, error) of bad files)."""
    return cells.where("error is null").drop("error"), cells.where("error is not null").select("path", "error")


def text_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, text, supplier): whole text files; the supplier is the file's stem."""
    docs = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return docs.withColumn("supplier", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1))
