"""The field registry as schemas and DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import fixed

_KINDS = {"TEXT": T.StringType(), "INTEGER": T.LongType(), "REAL": T.DoubleType()}
COLUMNS = tuple(f[0] for f in fixed.FIELDS)
SINK_NAMES = {f[0]: f[1] for f in fixed.FIELDS}
EDITABLE = (*COLUMNS, "status")


def registry_schema() -> T.StructType:
    """One nullable column for each field, with its sink name as comment."""
    return T.StructType([T.StructField(c, _KINDS[k], True, {"comment": sink}) for c, sink, _, k, _ in fixed.FIELDS])


def staged_schema() -> T.StructType:
    extra = "status string, source_file string, content_hash string, created_at timestamp"
    return T.StructType([T.StructField("id", T.LongType()), *registry_schema().fields, *T._parse_datatype_string(extra).fields])


def registry_table(spark: SparkSession) -> DataFrame:
    """(column, sink_name, name, kind, aliases)."""
    return spark.createDataFrame([(c, s, n, k, list(a)) for c, s, n, k, a in fixed.FIELDS], "column string, sink_name string, name string, kind string, aliases array<string>")


def table_ddl(name: str = "source_candidates") -> str:
    """CREATE TABLE text of the staged table."""
    return f"CREATE TABLE IF NOT EXISTS {name} ({staged_schema().simpleString()[7:-1].replace(':', ' ').replace(',', ', ')}) USING parquet"
