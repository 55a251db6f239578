"""Cells to rows: sheet selection, merged cells, header detection, pivots, text rows.

``cells`` is (path, sheet, row_no, col_no, value[, kind]); row_no counts the non-empty rows of a sheet from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.location import path_metadata
from ..functions.text import any_of, or_null, strip
from ..materialize import written
from .matching import map_headers

SHEET = ["path", "sheet"]
FIELDS = (
    "supplier", "supplierName", "location", "brand", "model", "modelName", "variant", "exteriorColor", "interiorColor", "priceExw", "priceFob", "priceFca", "costExwUsd",
    "costFobUsd", "costFcaUsd", "supplierPriceCny", "officialSuggestedPriceCny", "stockQuantity", "colorStock", "variantStock", "singleModelTotalStock", "minQuantity", "maxQuantity",
    "leadTime", "orderWaitDays", "steering", "steeringSetup", "marketRegion", "statusVehicle", "manufactureYear", "manufactureMonth", "manufactureYearMonth", "vinStatus",
    "confidence", "model_id", "variant_id", "notes",
)
ENTRIES = "array<struct<k:string,v:string>>"


def fill_merged(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """A5: every cell of a merged range takes the value of its first cell, if that has one.

    merges: (path, sheet, min_row, max_row, min_col, max_col). Ranges become cells, so the join is by equality.
    """
    spread = merges.select(*SHEET, F.col("min_row").alias("_r"), F.col("min_col").alias("_c"), F.explode(F.sequence("min_row", "max_row")).alias("row_no"), "min_col", "max_col")
    spread = spread.select(*SHEET, "_r", "_c", "row_no", F.explode(F.sequence("min_col", "max_col")).alias("col_no"))
    first = cells.select(*SHEET, F.col("row_no").alias("_r"), F.col("col_no").alias("_c"), F.col("value").alias("_top")).where("_top is not null")
    filled = spread.join(first, [*SHEET, "_r", "_c"]).select(*SHEET, "row_no", "col_no", "_top")
    return cells.join(filled, [*SHEET, "row_no", "col_no"], "full").withColumn("value", F.coalesce("_top", "value")).drop("_top")


def select_sheets(cells: DataFrame) -> DataFrame:
    """Only summary sheets where a file has several sheets and one is a summary; never source and note sheets."""
    summary = F.lower(strip(F.col("sheet"))).isin(*fixed.SUMMARY_SHEETS)
    per_file = cells.select("path", "sheet", summary.alias("s")).distinct().groupBy("path").agg(F.count("*").alias("_n"), F.max("s").alias("_any"))
    kept = cells.join(per_file, "path").where(~((F.col("_n") > 1) & F.col("_any")) | summary)
    return kept.where(~F.col("sheet").isin(*fixed.SKIPPED_SHEETS)).drop("_n", "_any")


def row_texts(cells: DataFrame) -> DataFrame:
    """(path, sheet, row_no, text): the cells of each row joined by blanks, in column order."""
    pairs = F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("col_no", "value"))))
    return cells.groupBy(*SHEET, "row_no").agg(F.trim(F.array_join(F.transform(pairs, lambda p: p["value"]), " ")).alias("text"))


def header_rows(cells: DataFrame, rules: DataFrame, first: int = 10) -> DataFrame:
    """(path, sheet, row_no) of header rows among the first rows: one cell maps to a primary field, no cell holds a
    price, the row is no remark."""
    return _header_rows(map_headers(cells.where(F.col("row_no") <= first), "value", rules))


def _header_rows(top: DataFrame) -> DataFrame:
    """The same for the first rows' cells with their fields."""
    number = F.when(F.col("kind") == "n", F.col("value").try_cast("double") > 1000) if "kind" in top.columns else F.lit(None).cast("boolean")
    price = F.coalesce(number, F.col("value").rlike(r"\d{5,6}"))
    remark = F.col("value").rlike(fixed.HEADER_REMARK)
    flags = top.groupBy(*SHEET, "row_no").agg(F.max(F.coalesce(price, F.lit(False))).alias("p"), F.max(F.coalesce(remark, F.lit(False))).alias("n"), F.max(F.coalesce(F.col("field").isin(*fixed.PRIMARY_FIELDS), F.lit(False))).alias("h"))
    return flags.where("h and not p and not n").select(*SHEET, "row_no")


def header_map(cells: DataFrame, rules: DataFrame, first: int = 10) -> DataFrame:
    """(path, sheet, col_no, field, raw, last_row): header rows merged, later rows win; of several model columns the
    second and later are variants."""
    top = written(map_headers(cells.where(F.col("row_no") <= first), "value", rules), "top-cells")
    mapped = top.join(_header_rows(top), [*SHEET, "row_no"])
    cols = mapped.groupBy(*SHEET, "col_no").agg(F.max_by("field", F.when(F.col("field").isNotNull(), F.col("row_no"))).alias("field"), F.max_by(strip(F.col("value")), F.when(F.col("value").isNotNull(), F.col("row_no"))).alias("raw"), F.max("row_no").alias("_last"))
    sheet, model = Window.partitionBy(*SHEET), F.col("field").isin("modelName", "model")
    rank = F.row_number().over(Window.partitionBy(*SHEET, model).orderBy("col_no"))
    return cols.withColumn("last_row", F.max("_last").over(sheet)).withColumn("field", F.when(model & (rank > 1), "variant").otherwise(F.col("field"))).drop("_last")


def data_rows(texts: DataFrame) -> DataFrame:
    """Rows that are neither blank nor remarks nor sums."""
    t = F.col("text")
    return texts.where((t != "") & ~t.rlike(fixed.ROW_REMARK) & ~F.lower(t).rlike(any_of(fixed.SUMMARY_WORDS)))


#: Sheets up to which their columns are sent to every task; beyond, rows are shuffled to their sheet's.
BROADCAST_SHEETS = 10_000


def _sheet_columns(headers: DataFrame) -> DataFrame:
    """One row per sheet: its columns as a map, the last header row, whether two columns have one name, and what its path says."""
    named = F.when(F.col("raw") != "", F.col("raw"))
    sheets = headers.groupBy(*SHEET).agg(F.map_from_entries(F.collect_list(F.struct("col_no", F.struct("field", "raw").alias("h")))).alias("_heads"), F.max("last_row").alias("_last"), (F.count(named) > F.count_distinct(named)).alias("_twice"))
    sheets = written(sheets.withColumn("_meta", path_metadata(F.col("path"))), "sheets")
    return F.broadcast(sheets) if sheets.count() <= BROADCAST_SHEETS else sheets


def _last_of(field: str) -> Column:
    """The rightmost cell of a field."""
    return F.try_element_at(F.filter("_named", lambda x: x["h"]["field"] == field), F.lit(-1))["v"]


def pivot_rows(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per data row: a column for each known field (the rightmost cell wins; path metadata fills supplier,
    location, brand and model), and raw_entries of raw header and cell, the first of a name, in column order.

    Cells are grouped once, into the rows' arrays; all else happens inside a row."""
    given = F.when(F.col("value").isNotNull(), F.struct("col_no", "value"))
    rows = cells.groupBy(*SHEET, "row_no").agg(F.array_sort(F.collect_list(given)).alias("_cells"))
    rows = rows.join(_sheet_columns(headers), SHEET).where("row_no > _last")
    rows = data_rows(rows.withColumn("text", F.trim(F.array_join(F.transform("_cells", lambda c: c["value"]), " "))))
    named = F.transform("_cells", lambda c: F.struct(F.try_element_at("_heads", c["col_no"]).alias("h"), c["value"].alias("v")))
    rows = rows.withColumn("_named", F.filter(named, lambda x: x["h"].isNotNull())).where(F.size("_named") > 0)
    mine = F.filter("_named", lambda x: (x["h"]["raw"] != "") & ~x["h"]["raw"].isin(*FIELDS))
    names = F.transform("_named", lambda x: F.when(~x["h"]["raw"].isin(*FIELDS), x["h"]["raw"]))
    first = F.filter(F.filter("_named", lambda x, i: F.array_position(names, x["h"]["raw"]) == i + 1), lambda x: (x["h"]["raw"] != "") & ~x["h"]["raw"].isin(*FIELDS))
    entries = F.transform(F.when(F.col("_twice"), first).otherwise(mine), lambda x: F.struct(x["h"]["raw"].alias("k"), x["v"].alias("v")))
    out = rows.select(*SHEET, "row_no", *[_last_of(f).alias(f) for f in FIELDS], F.when(F.size(entries) > 0, entries).alias("raw_entries"), "_meta")
    unknown = F.coalesce(strip(F.col("supplier")).isin("", *fixed.UNKNOWN_NAMES), F.lit(True))
    out = out.withColumn("supplier", F.when(unknown & F.col("_meta.supplier").isNotNull(), F.col("_meta.supplier")).otherwise(F.col("supplier")))
    for c in ("location", "brand", "model"):
        out = out.withColumn(c, F.coalesce(c, f"_meta.{c}"))
    present = F.lit(False)
    for c in fixed.PRESENCE_FIELDS:
        present = present | F.coalesce(F.col(c) != "", F.lit(False))
    return out.where(present).withColumn("_type", F.lit("structured")).drop("_meta")


def vertical_sheets(cells: DataFrame) -> DataFrame:
    """(path, sheet) of key/value tables: five rows or more, a first row of at most four cells, three key words in the
    first column of the first 15 rows."""
    key = (F.col("col_no") == 1) & (F.col("row_no") <= 15) & F.col("value").rlike(any_of(fixed.VERTICAL_KEYS))
    stats = cells.groupBy(*SHEET).agg(F.max("row_no").alias("n"), F.max(F.when(F.col("row_no") == 1, F.col("col_no"))).alias("w"), F.count_if(F.coalesce(key, F.lit(False))).alias("k"))
    return stats.where("n >= 5 and w <= 4 and k >= 3").select(*SHEET)


def pivot_vertical(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per sheet: mapped keys are fields (the last wins), the others notes 'key: value'; the model is the first
    value whose key names it."""
    text = strip(F.coalesce(F.col("value"), F.lit("")))
    pairs = cells.where("col_no <= 2").groupBy(*SHEET, "row_no").agg(F.max(F.when(F.col("col_no") == 1, text)).alias("key"), F.max(F.when(F.col("col_no") == 2, text)).alias("v")).where("key <> '' and v <> ''")
    mapped = map_headers(pairs, "key", rules)
    fields = mapped.groupBy(*SHEET).pivot("field", list(FIELDS)).agg(F.max_by("v", "row_no"))
    other = F.collect_list(F.when(F.col("field").isNull(), F.struct("row_no", F.concat_ws(": ", "key", "v").alias("t"))))
    more = mapped.groupBy(*SHEET).agg(F.array_sort(other).alias("o"), F.min(F.when(F.col("key").rlike(any_of(fixed.VERTICAL_MODEL_KEYS)), F.struct("row_no", "v"))).alias("m"))
    out = fields.join(more, SHEET).withColumn("_meta", path_metadata(F.col("path")))
    notes = F.concat_ws("; ", or_null(F.col("notes")), or_null(F.array_join(F.transform("o", lambda x: x["t"]), "; ")))
    out = out.withColumn("notes", or_null(notes)).withColumn("model", F.coalesce("m.v", "_meta.model"))
    for c in ("supplier", "location", "brand"):
        out = out.withColumn(c, F.coalesce(c, f"_meta.{c}"))
    return out.withColumn("row_no", F.lit(1)).withColumn("_type", F.lit("vertical_parameter")).withColumn("raw_entries", F.lit(None).cast(ENTRIES)).drop("_meta", "o", "m")


def carry_forward(value: Column, order: list[str], by: list[str] = SHEET) -> Column:
    """the last given value up to the row; wrap a value in a struct to carry a null of its own."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def text_rows(texts: DataFrame) -> DataFrame:
    """Listings in running text (path, sheet, row_no, text): model, trim and place are carried down, a row with a price
    and a known model is a listing."""
    t = texts.withColumn("text", strip(F.col("text"))).where(~F.col("text").rlike(fixed.TEXT_CONVERSION) & (F.col("text") != ""))
    t = t.withColumn("text", F.regexp_replace("text", r"(\d),(\d{3})", "$1$2")).withColumn("_meta", path_metadata(F.col("path")))
    get = lambda p, i=1: F.regexp_extract("text", p, i)
    given = lambda x: F.when(x != "", x)
    smart, l6 = fixed.TEXT_SMART, fixed.TEXT_L6
    is_smart, is_l6 = F.col("text").rlike(smart), F.col("text").rlike(l6)
    own_trim = given(strip(get(fixed.TEXT_TRIM)))
    trim = F.when(is_smart, F.struct(given(strip(get(smart, 2))).alias("t"))).when(is_l6, F.struct(F.when(get(l6).contains("MAX"), strip(get(l6))).otherwise(given(strip(get(l6, 2)))).alias("t"))).when(own_trim.isNotNull(), F.struct(own_trim.alias("t")))
    usd = F.coalesce(given(get(fixed.TEXT_USD_FRONT)), given(get(fixed.TEXT_USD_BEHIND)), given(get(fixed.TEXT_USD_TERM)))
    t = t.select(
        *SHEET, "row_no", "text", "_meta",
        F.when(is_smart, strip(get(smart))).when(is_l6, F.lit("L6")).alias("m"), trim.alias("t"), given(get(fixed.TEXT_PLACE)).alias("l"),
        given(get(fixed.TEXT_CNY)).try_cast("long").alias("cny"), usd.try_cast("long").alias("usd"),
    )
    t = t.withColumn("model", F.coalesce(carry_forward(F.col("m"), ["row_no"]), "_meta.model")).withColumn("variant", carry_forward(F.col("t"), ["row_no"])["t"])
    t = t.withColumn("location", F.coalesce(carry_forward(F.col("l"), ["row_no"]), "_meta.location"))
    # prices seen before any model is known wait for the first row that knows one
    known = F.coalesce(F.col("model") != "", F.lit(False))
    first = F.min(F.when(known, F.col("row_no"))).over(Window.partitionBy(*SHEET))
    for p in ("cny", "usd"):
        t = t.withColumn(f"_{p}", carry_forward(F.col(p), ["row_no"]))
    at_first = F.col("row_no") == first
    t = t.withColumn("cny", F.when(at_first, F.col("_cny")).otherwise(F.col("cny"))).withColumn("usd", F.when(at_first, F.col("_usd")).otherwise(F.col("usd")))
    t = t.where(known & (F.coalesce("cny", F.lit(0)) + F.coalesce("usd", F.lit(0)) > 0))
    return t.select(
        *SHEET, "row_no", F.col("_meta.supplier").alias("supplier"), "location", F.col("_meta.brand").alias("brand"), "model", "variant",
        F.nullif("usd", F.lit(0)).cast("string").alias("priceExw"), F.nullif("cny", F.lit(0)).cast("string").alias("officialSuggestedPriceCny"), F.col("text").alias("notes"), F.lit("unstructured_text").alias("_type"),
    )


def parse_cells(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of all sheets, each parsed by its kind: vertical table, table with headers, or text."""
    keys = [c for c in (*SHEET, "row_no", "col_no", "value", "kind") if c in cells.columns]
    used = written(select_sheets(cells).select(*keys), "used-cells")
    upright = written(vertical_sheets(used), "upright-sheets")
    flat = used.join(upright, SHEET, "left_anti")
    headers = written(header_map(flat, rules), "headers")
    headed = headers.select(*SHEET).distinct()
    out = pivot_rows(flat, headers)
    out = out.unionByName(pivot_vertical(used.join(upright, SHEET, "left_semi"), rules), allowMissingColumns=True)
    out = out.unionByName(text_rows(row_texts(flat.join(headed, SHEET, "left_anti"))), allowMissingColumns=True)
    if "content_hash" in cells.columns:
        out = out.join(cells.select("path", F.col("content_hash").alias("_content_hash")).distinct(), "path", "left")
    return out.withColumn("_source_file", F.regexp_extract("path", r"([^/]*)$", 1))


def manifest(rows: DataFrame, source: str = "path") -> DataFrame:
    """(source, row_count) for each source, and the total under a null source."""
    return rows.rollup(source).agg(F.count("*").alias("row_count")).withColumnRenamed(source, "source")
