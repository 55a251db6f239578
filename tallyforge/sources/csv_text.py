"""CSV files of any size as cells: lines are read in parts of a file, and only files whose records span lines are read whole."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..materialize import written
from .files import CELLS, fingerprinted, read_cells

#: Longest line that is taken apart here, as the limit on a field that the reader of whole files has; longer ones are left to it.
LINE_CHARS = 131_072
#: Blocks and files up to this number are sent to every task; beyond, they are joined by shuffling.
BROADCAST_BLOCKS = 200_000
_FIELD = r',(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'


def is_whole(line: Column) -> Column:
    """Whether a line is a record by itself: every quote opens a field at its beginning, closes it at its end, or is one of two
    that stand for one. Between the quotes, texts outside of fields begin and end with a comma or are empty."""
    parts = F.split(line, '"', -1)
    n = F.size(parts)
    outside = F.filter(parts, lambda _, i: i % 2 == 0)
    good = F.forall(
        F.transform(outside, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda p: (p["x"] == "") | (((p["i"] == 0) | F.startswith(p["x"], F.lit(","))) & ((p["i"] == (n - 1) / 2) | F.endswith(p["x"], F.lit(",")))),
    )
    return ~F.contains(line, F.lit('"')) | ((n % 2 == 1) & good)


def fields(line: Column) -> Column:
    """The fields of a whole line."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(0))
    quoted = F.transform(found, lambda f: F.when(F.substring(f, 2, 1) == '"', F.replace(F.substr(f, F.lit(3), F.length(f) - 3), F.lit('""'), F.lit('"'))).otherwise(F.substr(f, F.lit(2))))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_BLOCKS else df


def read_csv_cells(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("csv",), hashes: DataFrame | None = None) -> DataFrame:
    """The cells of the CSV files below ``root``, as ``files.read_cells`` gives them (``CELLS``).

    Files are read as lines, part by part, so a large file is spread over many tasks. Lines are written once with their place
    in their part; rows are then numbered by adding the rows of the parts before, so neither a sort nor a window goes over
    them. A file with a quoted field that spans lines, bytes that are not UTF-8 or a line beyond ``LINE_CHARS`` is told apart
    and read whole by ``files.read_cells``, as are those it calls damaged. ``content_hash`` comes from ``hashes`` (path,
    content_hash), if given; files that are read whole have their own.
    """
    source = spark.read.option("recursiveFileLookup", True).text(root)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # as other readers give it
    # (the reader of lines leaves out a byte order mark at the beginning of a file)
    lines = source.select(path.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    lines = lines.where(F.lower("path").rlike(rf"\.({'|'.join(suffixes)})$"))
    valid = F.coalesce(F.is_valid_utf8("line"), F.lit(True)) & (F.length("line") <= LINE_CHARS)
    lines = lines.withColumn("whole", F.when(valid, is_whole(F.col("line"))).otherwise(F.lit(False)))
    told = lines.withColumn("cells", F.when(F.col("whole"), fields(F.col("line")))).drop("line")
    # blank rows are dropped before the others get their places
    rows = written(told.where(~F.col("whole") | F.exists("cells", lambda c: c != "")).withColumn("at", F.monotonically_increasing_id()), "csv-rows")
    slow_paths = [r.path for r in rows.where("not whole").select("path").distinct().collect()]  # names of files, as the listing of the folder has them
    good = rows
    if slow_paths:
        good = rows.join(_sized(spark.createDataFrame([(p,) for p in slow_paths], "path string")), "path", "left_anti")
    # rows of a part stand together in one task's output, so their places are consecutive
    parts = good.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block")) - F.col("n")  # over the parts of a file, one row each
    offsets = parts.select("path", "block", "first", before.alias("rows_before"))
    numbered = good.join(_sized(written(offsets, "csv-offsets")), ["path", "block"])
    row_no = (F.col("rows_before") + F.col("at") - F.col("first") + 1).cast("int")
    cells = numbered.select("path", F.lit("Sheet1").alias("sheet"), F.lit(1).alias("sheet_no"), row_no.alias("row_no"), F.posexplode("cells").alias("c", "value"))
    if hashes is None:
        cells = cells.withColumn("content_hash", F.lit(None).cast("string"))
    else:
        cells = cells.join(hashes.select("path", "content_hash"), "path", "left")
    cells = cells.select("path", "content_hash", "sheet", "sheet_no", "row_no", (F.col("c") + 1).cast("int").alias("col_no"), "value", F.lit("s").alias("kind"), F.lit(False).alias("merged"), F.lit(None).cast("string").alias("error"))
    if not slow_paths:
        return cells
    whole = spark.read.format("binaryFile").load([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in slow_paths])
    named = fingerprinted(whole).withColumn("path", F.concat("path", F.lit(".csv")))  # whatever the suffix, it is read as such
    return cells.unionByName(read_cells(named).withColumn("path", F.regexp_replace("path", r"\.csv$", "")).select(*[c.split()[0] for c in CELLS.split(", ")]))
