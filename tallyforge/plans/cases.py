"""Registered queries for the branches that plain columns of the driver tables never reach: sheets, texts and records made of
those columns, row by row, so that they grow with the tables. Inputs are SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed, registry, rules
from ..functions import color, dates, location, numbers, price, state, text, variant
from ..materialize import shared_folder, written
from ..operators import candidates, changes, deltas, grid, identity, matching, staging, validation
from ..sources import csv_text, files, records, workbooks
from ..streaming import jobs as streams
from ..streaming import versions
from . import jobs
from .offers import KEY
from .offers import SQL as OFFERS_SQL
from .queries import K, NUM, USD, candidates_full, offers, query, table, values

_STRIP = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """``sql`` over driver tables, named {table}."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def _duck(sql: str, *names: str) -> str:
    return sql.format(**{n: n for n in names})


def with_place(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (path, sheet, row_no, cells array) as cells."""
    return df.select(*columns, F.posexplode("cells").alias("c", "value")).select(*columns, (F.col("c") + 1).alias("col_no"), "value").where("value is not null")


# ---- sheets

_SHEETS = """SELECT doc_id AS row_no, doc_id % 40 AS file_no,
 CASE CAST((doc_id % 40) % 3 AS INT) WHEN 0 THEN CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN ' 汇总 ' WHEN 1 THEN '说明' ELSE concat('s', CAST(doc_id % 5 AS VARCHAR(9))) END
  WHEN 1 THEN CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN 'Trace' ELSE concat('t', CAST(doc_id % 7 AS VARCHAR(9))) END ELSE 'Summary' END AS sheet, source FROM {documents}"""
_SUMMARY = f"lower(trim(sheet)) IN ({', '.join(repr(x.lower()) for x in fixed.SUMMARY_SHEETS)})"


@query(f"""WITH s AS ({_duck(_SHEETS, 'documents')}), f AS (SELECT file_no, count(DISTINCT sheet) AS n, bool_or({_SUMMARY}) AS any_summary FROM s GROUP BY file_no)
 SELECT s.file_no AS path, sheet, row_no, source AS value FROM s JOIN f USING (file_no) WHERE (n = 1 OR NOT any_summary OR {_SUMMARY}) AND sheet NOT IN ({', '.join(repr(x) for x in fixed.SKIPPED_SHEETS)})""")
def sheet_select(spark, sf_dir):
    """Documents as rows of files with summary, source and plain sheets"""
    s = view(spark, sf_dir, _SHEETS, "documents").select(F.col("file_no").alias("path"), "sheet", "row_no", F.lit(1).alias("col_no"), F.col("source").alias("value"))
    return grid.select_sheets(s).select("path", "sheet", "row_no", "value")


_TEXT_LINES = """SELECT doc_id, pos, CASE WHEN pos % 11 = 3 THEN concat('注：', line) WHEN pos % 13 = 5 THEN concat(line, ' 合计 ', CAST(doc_id AS VARCHAR(20))) WHEN pos % 17 = 6 THEN concat('Sub', 'TOTAL ', line)
 WHEN pos % 19 = 7 THEN concat('见注：', line) WHEN pos % 23 = 8 THEN '' ELSE line END AS text FROM"""
_DOC_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"


@query(f"""SELECT doc_id AS path, pos AS row_no, text FROM ({_TEXT_LINES} {_DOC_LINES}) WHERE text <> '' AND NOT regexp_matches(text, '^(以上|注：|注:|说明)') AND NOT regexp_matches(lower(text), '{'|'.join(fixed.SUMMARY_WORDS)}')""")
def text_rows_kept(spark, sf_dir):
    """Lines of documents, some of them remarks, sums or blank"""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    t = spark.sql(f"{_TEXT_LINES} {{lines}}", lines=lines)
    return grid.data_rows(t.select(F.col("doc_id").alias("path"), F.col("pos").cast("long").alias("row_no"), "text"))


@query("""WITH c AS (SELECT doc_id AS path, row_no, unnest(string_split(line, ' ')) AS value, generate_subscripts(string_split(line, ' '), 1) AS col_no
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS row_no FROM documents)),
 m AS (SELECT doc_id AS path, r AS row_no, k AS col_no FROM documents, range(1, 3) a(r), range(1, 4) b(k)), top AS (SELECT path, value AS top FROM c WHERE row_no = 1 AND col_no = 1),
 filled AS (SELECT coalesce(c.path, m.path) AS path, coalesce(c.row_no, m.row_no) AS row_no, coalesce(c.col_no, m.col_no) AS col_no, CASE WHEN m.path IS NOT NULL THEN top ELSE value END AS value
  FROM c FULL JOIN m USING (path, row_no, col_no) JOIN top ON top.path = coalesce(c.path, m.path))
 SELECT path, row_no, col_no, value FROM filled WHERE row_no <= 3""")
def merged_fill(spark, sf_dir):
    """A5: the words of documents as cells, with a merged block of 2 x 3 cells at the top; values of the first three rows"""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.lit("s").alias("sheet"), F.posexplode(F.split("text", "\n")).alias("r", "line"))
    c = d.select("path", "sheet", (F.col("r") + 1).cast("long").alias("row_no"), F.posexplode(F.split("line", " ")).alias("c", "value")).select("path", "sheet", "row_no", (F.col("c") + 1).cast("long").alias("col_no"), "value")
    m = c.select("path", "sheet").distinct().select("path", "sheet", *[F.lit(v).cast("long").alias(n) for n, v in (("min_row", 1), ("max_row", 2), ("min_col", 1), ("max_col", 3))])
    return grid.fill_merged(c, m).where("row_no <= 3").select("path", "row_no", "col_no", "value")


_FORM_ROWS = f"""SELECT {K}, supplier, qty, raw_brand, raw_model, m, CASE WHEN m % 10 = 9 THEN '' ELSE concat('V', CAST(m AS VARCHAR(9))) END AS trim_text, concat('x', CAST(l_orderkey AS VARCHAR(20))) AS extra FROM """
_FORM_HEAD = (("价格说明 2025",), ("品牌", "车型", "型号", "报价", "数量", "供应商", "内部编号"), (None, None, None, "EXW", None, None, "编码"))


@query(f"""WITH {OFFERS_SQL}, o AS ({_FORM_ROWS} offers) SELECT supplier, CASE CAST(m % 6 AS INT) WHEN 0 THEN supplier || '-own' WHEN 1 THEN '未知' WHEN 2 THEN '无' END AS supplier_name, nullif(raw_brand, '') AS brand, coalesce(nullif(raw_model, ''), NULL) AS model, nullif(trim_text, '') AS variant,
  CASE WHEN m % 4 <> 1 THEN 10000 + qty END AS price, extra AS raw_value, qty, '南沙' AS location FROM o WHERE m % 7 <> 3 AND m % 11 <> 4""")
def sheet_forms(spark, sf_dir):
    """Sheets of offers with a remark row, two stacked header rows, two model columns, an unmapped column, unknown
    suppliers, remark and sum rows, back to rows"""
    o = spark.sql(f"{_FORM_ROWS} {{o}}", o=offers(spark, sf_dir))
    sheet = [F.concat(F.lit("/input/"), "supplier", F.lit("/FCA 南沙/b/m/f.csv")).alias("path"), F.lit("Sheet1").alias("sheet")]
    own = F.when(F.expr("m % 6 = 0"), F.concat("supplier", F.lit("-own"))).when(F.expr("m % 6 = 1"), F.lit("未知")).when(F.expr("m % 6 = 2"), F.lit("无"))
    amount = F.when(F.expr("m % 4 <> 1"), (F.lit(10000) + F.col("qty")).cast("string"))
    given = lambda c: F.when(F.col(c) != "", F.col(c))
    cells = F.array(given("raw_brand"), given("raw_model"), given("trim_text"), amount, F.col("qty").cast("string"), own, F.col("extra"))
    remark = F.when(F.expr("m % 7 = 3"), F.array(F.lit("注：以港口为准"), F.col("extra"))).when(F.expr("m % 11 = 4"), F.array(F.lit("合计"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("99999"))).otherwise(cells)
    body = o.select(*sheet, F.struct(*KEY).alias("k"), remark.alias("cells"))
    body = body.withColumn("row_no", F.row_number().over(Window.partitionBy("path").orderBy("k")) + 3).select("path", "sheet", "row_no", "cells")
    head = [F.array(*[F.lit(v).cast("string") for v in row]) for row in _FORM_HEAD]
    heads = body.select("path", "sheet").distinct().select("path", "sheet", F.posexplode(F.array(*head)).alias("r", "cells")).select("path", "sheet", (F.col("r") + 1).alias("row_no"), "cells")
    c = written(with_place(heads.unionByName(body), ["path", "sheet", "row_no"]), "forms")
    rows = grid.pivot_rows(c, written(grid.header_map(c, rules.header_rules(spark)), "headers"))
    raw = F.get(F.filter("raw_entries", lambda e: e["k"] == "编码"), F.lit(0))["v"]
    return rows.select("supplier", F.col("supplierName").alias("supplier_name"), F.when(F.col("brand") != "b", F.col("brand")).alias("brand"), F.when(F.col("modelName").isNotNull(), F.col("modelName")).alias("model"), "variant", numbers.to_number(F.col("priceExw")).alias("price"), raw.alias("raw_value"), numbers.to_number(F.col("stockQuantity")).alias("qty"), "location")


@query("""SELECT '/input/S' || c_nationkey || '/L/B/M/' || c_custkey || CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN '.csv' WHEN 1 THEN '.xlsx' ELSE '.txt' END AS path, 'S' || c_nationkey AS supplier,
  CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'structured' WHEN 1 THEN 'vertical_parameter' ELSE 'unstructured_text' END AS kind, c_custkey || CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN '.csv' WHEN 1 THEN '.xlsx' ELSE '.txt' END AS source_file,
  'h' || c_custkey AS content_hash, CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN c_name WHEN 1 THEN c_name ELSE 'M' END AS model, CASE WHEN c_custkey % 3 <> 1 THEN CAST(10000 + c_custkey AS VARCHAR) END AS price FROM customer""")
def sheet_routing(spark, sf_dir):
    """Customers as table sheets, key/value sheets and running text, each parsed by its kind"""
    c = table(spark, sf_dir, "customer")
    form = (F.col("c_custkey") % 3).cast("int")
    price_ = (F.lit(10000) + F.col("c_custkey")).cast("string")
    s, n = (lambda x: F.lit(x)), F.lit(None).cast("string")
    tables = F.array(F.array(s("车型"), s("EXW")), F.array(F.col("c_name"), price_))
    upright = F.array(F.array(s("项目名称"), F.col("c_name")), F.array(s("品牌"), s("BYD")), F.array(s("颜色"), F.col("c_mktsegment")), F.array(s("电池"), s("x")), F.array(s("续航"), s("y")))
    running = F.array(F.array(F.concat(s("今日 $"), price_), n), F.array(s("没有"), n))
    ending = F.when(form == 0, ".csv").when(form == 1, ".xlsx").otherwise(".txt")
    path = F.concat(s("/input/S"), F.col("c_nationkey").cast("string"), s("/L/B/M/"), F.col("c_custkey").cast("string"), ending)
    rows = c.select(path.alias("path"), s("Sheet1").alias("sheet"), F.concat(s("h"), F.col("c_custkey").cast("string")).alias("content_hash"), F.posexplode(F.when(form == 0, tables).when(form == 1, upright).otherwise(running)).alias("r", "cells"))
    cells = written(with_place(rows.withColumn("row_no", F.col("r") + 1).drop("r"), ["path", "sheet", "content_hash", "row_no"]), "routing")
    out = grid.parse_cells(cells, rules.header_rules(spark))
    return out.select("path", "supplier", F.col("_type").alias("kind"), F.col("_source_file").alias("source_file"), F.col("_content_hash").alias("content_hash"), F.coalesce("modelName", "model").alias("model"), F.col("priceExw").alias("price"))


# ---- fields of a listing


@query(f"""WITH {OFFERS_SQL} SELECT {K}, CASE WHEN m % 5 IN (0, 3) THEN supplier WHEN m % 3 = 0 THEN 'N' || m ELSE 'P' || qty END AS chosen,
  CASE WHEN m % 3 = 1 THEN NULL WHEN m % 3 = 2 THEN 110 + m ELSE qty END AS stock, nullif(concat_ws('; ', CASE WHEN m % 2 = 0 THEN 'n' || m END, CASE WHEN m % 7 = 0 THEN 'p' || qty END), '') AS notes FROM offers""")
def listing_fields(spark, sf_dir):
    """Supplier, stock and notes of offers out of columns that are blank, unknown or zero in turn"""
    o = offers(spark, sf_dir)
    own = F.expr("CASE CAST(m % 5 AS INT) WHEN 0 THEN supplier WHEN 1 THEN '未识别' WHEN 2 THEN '' WHEN 3 THEN supplier ELSE CAST(NULL AS STRING) END")
    name = F.expr("CASE WHEN m % 3 = 0 THEN concat('N', CAST(m AS STRING)) ELSE '' END")
    stock = state.stock_quantity([F.expr("CASE WHEN m % 3 = 0 THEN concat(CAST(qty AS STRING), '台') WHEN m % 3 = 1 THEN '0' END")], color.parse_colour(F.expr("CASE WHEN m % 3 = 2 THEN concat(CAST(110 + m AS STRING), '白') ELSE '白' END"))["quantity"])
    notes = state.joined_notes(F.expr("CASE WHEN m % 2 = 0 THEN concat(' n', CAST(m AS STRING), ' ') ELSE ' ' END"), F.expr("CASE WHEN m % 7 = 0 THEN concat('p', CAST(qty AS STRING)) END"))
    return o.select(*KEY, state.supplier_choice(own, name, F.concat(F.lit("P"), F.col("qty").cast("string"))).alias("chosen"), stock.alias("stock"), notes.alias("notes"))


_GUIDE = """CASE CAST(m % 6 AS INT) WHEN 0 THEN concat('指导价：', CAST(amt AS VARCHAR(20)), '元') WHEN 1 THEN concat('msrp about ', CAST(amt * 10 AS VARCHAR(20))) WHEN 2 THEN concat('国内售价 ', CAST(amt * 1000 AS VARCHAR(20)))
  WHEN 3 THEN concat('指导价 ', CAST(qty AS VARCHAR(20))) WHEN 4 THEN concat('标价 ', CAST(amt AS VARCHAR(20))) ELSE concat('对标价----------------', CAST(amt AS VARCHAR(20))) END"""
_AMT = "(SELECT *, CAST(length(p) AS BIGINT) AS np FROM (SELECT {k}, m, qty, price_text, CAST(qty * 1000 + m * 137 AS BIGINT) AS amt, price_text AS p FROM "


@query(f"""WITH {OFFERS_SQL}, t AS (SELECT {K}, m, qty, amt FROM {_AMT.format(k=K)} offers))), x AS (SELECT *, CASE CAST(m % 6 AS INT) WHEN 0 THEN amt WHEN 1 THEN amt * 10 WHEN 2 THEN amt * 1000 END AS n FROM t)
 SELECT {K}, CASE WHEN n BETWEEN 20000 AND 2000000 THEN n WHEN n >= 10000000 AND n // 10 BETWEEN 20000 AND 2000000 AND length(CAST(n AS VARCHAR)) > 7 THEN CAST(substr(CAST(n AS VARCHAR), 1, 7) AS BIGINT) END AS guide FROM
 (SELECT {K}, CASE WHEN length(CAST(n AS VARCHAR)) > 7 THEN CAST(substr(CAST(n AS VARCHAR), 1, 7) AS BIGINT) WHEN length(CAST(n AS VARCHAR)) < 5 THEN NULL ELSE n END AS n FROM x)""")
def guide_price(spark, sf_dir):
    """Guide prices in remarks of offers"""
    t = spark.sql(f"SELECT {K}, {_GUIDE} AS t FROM {_AMT.format(k=K)} {{o}}))", o=offers(spark, sf_dir))
    return t.select(*KEY, price.guide_price_in_text(F.col("t")).alias("guide"))


@query(f"""WITH {OFFERS_SQL} SELECT {K}, 'FOB价 ' || price_text || ' remark ' || CASE WHEN m % 3 = 0 THEN 'fob only' ELSE 'Fob or exw' END AS fob, concat_ws(' ', CASE WHEN contains(lower(price_text), 'exw') THEN 'FOB价 ' || price_text END, CASE WHEN m % 3 <> 0 THEN 'remark Fob or exw' END) AS exw,
  CASE WHEN m % 4 = 0 THEN NULL WHEN m % 4 = 1 THEN qty ELSE 7000 + m END AS of_first, CASE WHEN m % 4 = 0 THEN NULL WHEN m % 4 = 1 THEN NULL ELSE 7000 + m END AS of_first_given FROM offers""")
def price_keys(spark, sf_dir):
    """What names a term among the entries of an offer, and the first of several number columns"""
    o = offers(spark, sf_dir)
    remark = F.expr("CASE WHEN m % 3 = 0 THEN 'fob only' ELSE 'Fob or exw' END")
    pairs = [("FOB价", F.col("price_text")), ("数量", F.col("qty").cast("string")), ("remark", remark)]
    entries = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in pairs])
    a, b = F.expr("CASE WHEN m % 4 = 1 THEN '面议' WHEN m % 4 >= 2 THEN concat('$', CAST(7000 + m AS STRING)) END"), F.expr("CASE WHEN m % 4 = 1 THEN CAST(qty AS STRING) WHEN m % 4 >= 2 THEN '5' END")
    return o.select(*KEY, price.term_context(entries, "FOB").alias("fob"), price.term_context(entries, "EXW").alias("exw"), numbers.number_of_first(a, b).alias("of_first"), numbers.number_of_first_given(a, b).alias("of_first_given"))


_NOISY = """SELECT {k}, CASE WHEN m % 9 = 0 THEN '未知' WHEN m % 13 = 1 THEN concat('来源', raw_brand) ELSE raw_brand END AS brand,
 CASE WHEN m % 7 = 0 THEN concat(raw_model, ' 小结') WHEN m % 8 = 1 THEN 'SubTotal' WHEN m % 11 = 2 THEN '待确认车型' ELSE concat(raw_model, CAST(qty AS VARCHAR(20))) END AS model, CASE WHEN m % 10 = 3 THEN concat('xx SGMW ', supplier) ELSE supplier END AS scope FROM """


@query(f"""WITH {OFFERS_SQL}, t AS ({_NOISY.format(k=K)} offers) SELECT {K}, CASE WHEN contains(scope, 'SGMW') THEN '{fixed.CODE_BRAND}' ELSE brand END AS brand, model FROM t
 WHERE brand <> '' AND model <> '' AND brand NOT IN ('未知', 'unknown') AND model NOT IN ('待确认车型', '未知', 'unknown') AND NOT regexp_matches(lower(model), '注：|来源|合计|小计|总计|小结|加价|车型代码|subtotal|total') AND NOT regexp_matches(lower(brand), '注：|来源|合计|小计')""")
def noise_rows(spark, sf_dir):
    """Offers with unknown, sum and source rows in between, and a product line's brand from its search text"""
    t = spark.sql(f"{_NOISY.format(k=K)} {{o}}", o=offers(spark, sf_dir))
    t = identity.resolved_only(t, "brand", "model")
    return t.select(*KEY, identity.override_brand(F.col("brand"), F.col("scope")).alias("brand"), "model")


_MODELS = values([(i, *r) for i, r in enumerate(rules.built_in_brand_models())])
_RULES = f"r(prio, raw_brand, raw_model, brand, model) AS ({_MODELS})"
_BRAND_CELL = """SELECT p_partkey, concat(CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN '2025款 ' WHEN 1 THEN concat(p_brand, '/') WHEN 2 THEN p_name WHEN 3 THEN '款' ELSE '(' END,
 CASE CAST(floor(p_partkey / 5.0) AS INT) % 7 WHEN 0 THEN 'Seagull' WHEN 1 THEN '海豚' WHEN 2 THEN 'T03' WHEN 3 THEN 'M9' WHEN 4 THEN '豹5' WHEN 5 THEN 'A7' ELSE p_type END, CASE WHEN p_size % 3 = 0 THEN ')' WHEN p_size % 3 = 1 THEN concat(' ', CAST(p_size AS VARCHAR(9))) ELSE '' END) AS cell FROM {part}"""


@query(f"""WITH {_RULES}, k AS ({_duck(_BRAND_CELL, 'part')}), hit AS (SELECT p_partkey, min(prio) AS prio FROM k JOIN r ON length(raw_model) >= 2 AND CASE WHEN contains(lower(cell), raw_model) THEN regexp_matches(lower(cell), '(^|[^\\p{{L}}\\p{{N}}_])' || regexp_escape(raw_model) || '($|[^\\p{{L}}\\p{{N}}_])') ELSE FALSE END GROUP BY p_partkey)
 SELECT k.p_partkey, k.cell, r.brand AS mapped_brand, r.model AS mapped_model FROM k LEFT JOIN hit USING (p_partkey) LEFT JOIN r USING (prio)""")
def model_in_brand(spark, sf_dir):
    """A listed model as a whole word inside a brand cell"""
    return matching.model_in_brand(view(spark, sf_dir, _BRAND_CELL, "part"), "cell", rules.brand_models(spark))


_SQ = lambda x: f"lower(replace({x}, ' ', ''))"
_OFFICIAL = """SELECT p_partkey, concat(CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN 'GAC Aion' WHEN 1 THEN 'gac' WHEN 2 THEN 'new Geely auto' WHEN 3 THEN 'Leapmotor' WHEN 4 THEN p_brand ELSE 'byd' END, CASE WHEN p_size % 4 = 0 THEN CAST(p_size AS VARCHAR(9)) ELSE '' END) AS b,
 concat(CASE CAST(p_partkey % 7 AS INT) WHEN 0 THEN 'galaxy e5' WHEN 1 THEN 'Seagull' WHEN 2 THEN 'the Leopard 5' WHEN 3 THEN 't03' WHEN 4 THEN 'M9' WHEN 5 THEN p_type ELSE 'Galaxy A7' END, CASE WHEN p_size % 5 = 0 THEN ' max' ELSE '' END) AS m FROM {part}"""


@query(f"""WITH {_RULES}, k AS ({_duck(_OFFICIAL, 'part')}), bs AS (SELECT brand, min(prio) AS p FROM r GROUP BY brand), ms AS (SELECT model, min(prio) AS p FROM r GROUP BY model),
 hb AS (SELECT p_partkey, arg_min(brand, (-length(brand), p)) AS official_brand FROM k JOIN bs ON {_SQ('brand')} = {_SQ('b')} OR contains({_SQ('b')}, lower(brand)) GROUP BY p_partkey),
 hm AS (SELECT p_partkey, arg_min(model, (-length(model), p)) AS official_model FROM k JOIN ms ON {_SQ('model')} = {_SQ('m')} OR (length({_SQ('model')}) > 2 AND contains({_SQ('m')}, {_SQ('model')})) GROUP BY p_partkey)
 SELECT k.p_partkey, official_brand, official_model FROM k LEFT JOIN hb USING (p_partkey) LEFT JOIN hm USING (p_partkey)""")
def official_names(spark, sf_dir):
    """The longest official brand and model inside a text"""
    return identity.official_names(view(spark, sf_dir, _OFFICIAL, "part"), "b", "m", rules.brand_models(spark)).select("p_partkey", "official_brand", "official_model")


_DIMENSION = "SELECT p_brand AS model_id, concat(p_type, CASE WHEN p_size % 2 = 0 THEN ' plus' ELSE '' END) AS variant, concat('V', CAST(p_partkey AS VARCHAR(20))) AS trim_config_id, p_partkey AS ord FROM {part} WHERE p_partkey % 3 = 0"
_ASKED = "SELECT p_partkey, p_brand AS model_id, CASE CAST(p_size % 4 AS INT) WHEN 0 THEN upper(p_type) WHEN 1 THEN concat(p_type, ' Plus edition') WHEN 2 THEN substr(p_type, 1, 3) ELSE concat(' ', p_name) END AS v FROM {part}"


@query(f"""WITH d AS (SELECT model_id, lower(variant) AS variant, arg_max(trim_config_id, ord) AS id, min(ord) AS prio FROM ({_duck(_DIMENSION, 'part')}) GROUP BY 1, 2), q AS (SELECT *, lower(trim(v)) AS t FROM ({_duck(_ASKED, 'part')})),
 hit AS (SELECT p_partkey, arg_min(id, (t <> variant, prio)) AS variant_id FROM q JOIN d USING (model_id) WHERE contains(t, variant) OR contains(variant, t) GROUP BY p_partkey)
 SELECT q.p_partkey, hit.variant_id FROM q LEFT JOIN hit USING (p_partkey)""")
def variant_lookup(spark, sf_dir):
    """Variants of a dimension made of parts, found by equality, else by containment"""
    d = view(spark, sf_dir, _DIMENSION, "part").withColumn("trim_config", F.lit(None).cast("string")).withColumn("variant_id", F.lit(None).cast("string")).withColumn("record_id", F.lit(None).cast("string"))
    return matching.lookup_by_containment(view(spark, sf_dir, _ASKED, "part"), records.variant_index(d), "model_id", "v").select("p_partkey", "variant_id")


_NAMES = "concat(p_name, CASE CAST(p_size % 5 AS INT) WHEN 0 THEN ' a/b' WHEN 1 THEN ': 50*2?' WHEN 2 THEN ' <x>|y' ELSE concat(chr(92), '\"z\"') END)"


@query(f"SELECT p_partkey, translate({_NAMES}, '\\/*?:\"<>|', '_________') AS name FROM part")
def safe_names(spark, sf_dir):
    """C41"""
    return table(spark, sf_dir, "part").select("p_partkey", text.safe_name(F.expr(_NAMES.replace("chr(92)", "char(92)"))).alias("name"))


# ---- variants

#: (brand, model, text with {n} for a number of the row, variant, notes)
VARIANTS = (
    ("Changan", "Qiyuan A07", "Qiyuan A07 730旗舰型", "730旗舰型", None),
    ("Changan", "Qiyuan A07", "Qiyuan A07 730旗舰型 | {n} | 宁德83kWh", "730旗舰型", "配置详情: {n}; 宁德83kWh"),
    ("Leapmotor", "T03", "T032025款310舒享版", "2025款310舒享版", None),
    ("Farizon", "Xingxiang V", "短轴低顶-行镖版", "短轴低顶-行镖版", None),
    ("Farizon", "Xingxiang V", "中轴低顶", None, None),
    ("BYD", "Seagull", "430km", None, None),
    ("BYD", "Seagull", "49.92kWh", None, None),
    ("BYD", "Seagull", "FOB {n}", None, None),
    ("BYD", "Seagull", "{n}", None, None),
    ("Leapmotor", "T03", "LV2", None, None),
    ("BYD", "Seagull", "BYD Seagull 豪华版", "豪华版", None),
    ("BYD", "Seagull", "Seagull", None, None),
    ("BYD", "Seagull", "豪华版 EXW{n}", "豪华版", None),
    ("Geely", "Galaxy E5", "Galaxy E5", None, None),
    ("BYD", "Seagull", "旗舰版（电动座椅{n}）", "旗舰版", "配置详情: 旗舰版（电动座椅{n}）"),
    ("BYD", "Seagull", "领先版\n空调 雷达 {n}", "领先版", "配置详情: 空调 雷达 {n}"),
    ("Zeekr", "001", "001 四驱版", "四驱版", None),
    ("BYD", "Seagull", "T9", "T9", None),
)
_N = "CAST(100000 + l_partkey AS VARCHAR(20))"
_CASE = f"CAST((l_orderkey * 7 + l_linenumber) % {len(VARIANTS)} AS INT)"


def _of_case(i: int) -> str:
    q = lambda v: "CAST(NULL AS VARCHAR(99))" if v is None else "'" + v.replace("\n", "#") + "'"
    return " ".join(f"WHEN {k} THEN replace(replace({q(c[i])}, '{{n}}', {_N}), '#', chr(10))" for k, c in enumerate(VARIANTS))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE {_CASE} {_of_case(3)} END AS variant, CASE {_CASE} {_of_case(4)} END AS notes FROM lineitem")
def variant_clean(spark, sf_dir):
    """Texts with a stated variant and stated notes, on distinct keys"""
    case = lambda i: F.expr(f"CASE {_CASE} {_of_case(i)} END".replace("VARCHAR(99)", "STRING").replace("VARCHAR(20)", "STRING"))
    none = F.lit(None).cast("string")
    t = table(spark, sf_dir, "lineitem").select(*KEY, case(0).alias("brand"), case(1).alias("model"), case(2).alias("_variant_text"), none.alias("_raw_brand"), none.alias("_raw_model"), none.alias("_note"), F.array().cast("array<string>").alias("_context"))
    return candidates.with_variants(t, rules.brand_models(spark)).select(*KEY, "variant", "notes")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE CAST(l_orderkey % 4 AS INT) WHEN 0 THEN '领先版' WHEN 1 THEN '豪华版' WHEN 2 THEN NULL ELSE '330舒享版' END AS variant FROM lineitem""")
def variant_context(spark, sf_dir):
    """Variants out of context fields: file names, other columns, or none that names one"""
    none = F.lit(None).cast("string")
    file = F.concat(F.lit("领先版"), F.lit(".xlsx"))
    context = F.when(F.expr("l_orderkey % 4 = 0"), F.array(F.concat((F.lit(100000) + F.col("l_partkey")).cast("string")), file)).when(F.expr("l_orderkey % 4 = 1"), F.array(F.lit("Seagull"), F.lit("Seagull_豪华版"))).when(F.expr("l_orderkey % 4 = 2"), F.array(F.lit("430km"))).otherwise(F.array(F.lit("330舒享版"), file))
    t = table(spark, sf_dir, "lineitem").select(*KEY, F.lit("BYD").alias("brand"), F.lit("Seagull").alias("model"), none.alias("_variant_text"), none.alias("_raw_brand"), none.alias("_raw_model"), none.alias("_note"), context.alias("_context"))
    return candidates.with_variants(t, rules.brand_models(spark)).select(*KEY, "variant")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 3 = 0 THEN 'stem ' || l_partkey WHEN l_linenumber % 4 = 0 THEN 'M' || l_suppkey WHEN l_linenumber % 4 = 1 THEN 'M' || l_suppkey || ' trim ' || l_partkey WHEN l_linenumber % 4 = 2 THEN 'trim ' || l_partkey ELSE 'xM' || l_suppkey || 'y' END AS source FROM lineitem""")
def variant_choice(spark, sf_dir):
    """File stem, raw model and variant field in turn"""
    t = table(spark, sf_dir, "lineitem")
    s = lambda c: F.col(c).cast("string")
    m = F.concat(F.lit("M"), s("l_suppkey"))
    step = F.col("l_linenumber") % 4
    file = F.when(F.expr("l_orderkey % 3 = 0"), F.concat(F.lit("stem "), s("l_partkey"), F.lit(".xlsx"))).otherwise(F.concat(F.lit("报价"), s("l_partkey"), F.lit(".xlsx")))
    given = F.when(step == 0, None).when(step == 3, F.concat(F.lit("x"), m, F.lit("y"))).otherwise(F.concat(F.lit("trim "), s("l_partkey")))
    raw = F.when(step == 2, F.lit("seagull")).otherwise(m)
    return t.select(*KEY, variant.variant_source(file, [F.lit(""), given], raw, F.lit("BYD"), F.lit("Seagull")).alias("source"))


# ---- records, sinks, rules, streams


@query("""WITH s AS (SELECT *, date_trunc('day', ts) AS day FROM events) SELECT event_id, user_id, event_type FROM s WHERE day = (SELECT max(day) FROM s)""")
def latest_snapshot(spark, sf_dir):
    """The events of the newest day as the newest snapshot"""
    e = table(spark, sf_dir, "events").withColumn("snapshot_ts", F.date_trunc("day", "ts"))
    return records.latest_snapshot(e).select("event_id", "user_id", "event_type")


_SUNK = """SELECT s_suppkey % 7 AS part_no, {K}, supplier, nullif(raw_brand, '未知') AS brand, nullif(raw_model, '') AS model, CASE WHEN m % 3 = 0 THEN '国际版' WHEN m % 3 = 1 THEN '' END AS version_type, CASE WHEN m % 4 = 0 THEN 'n' WHEN m % 4 = 1 THEN '' END AS notes, qty AS cost_exw_usd FROM (SELECT *, l_suppkey AS s_suppkey FROM """


def _sunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_SUNK.format(K=K) + "{o})", o=offers(spark, sf_dir))


@query(f"""WITH {OFFERS_SQL}, t AS ({_SUNK.format(K=K)} offers)) SELECT 'src' || part_no AS source_file, {K}, supplier, brand, model, cost_exw_usd FROM t UNION ALL SELECT 'csv', {K}, supplier, brand, model, cost_exw_usd FROM (SELECT NULL::BIGINT AS l_orderkey, NULL::INT AS l_linenumber, NULL::BIGINT AS l_partkey, NULL::BIGINT AS l_suppkey, supplier, brand, model, cost_exw_usd FROM t)""")
def sinks_read_back(spark, sf_dir):
    """Candidates written as JSON by source and as CSV, and read again"""
    rows = _sunk(spark, sf_dir).withColumn("source_file", F.concat(F.lit("src"), F.col("part_no").cast("string"))).drop("part_no")
    path = shared_folder(spark, "sinks")
    records.write_by_source(rows, f"{path}/json")
    records.write_csv(rows, f"{path}/csv")
    back = records.read_json_array(spark, f"{path}/json", rows.schema)
    sheet = spark.read.option("header", True).schema(registry.registry_schema()).csv(f"{path}/csv")
    wide = sheet.select(F.lit("csv").alias("source_file"), *[F.lit(None).cast(dict(rows.dtypes)[k]).alias(k) for k in KEY], "supplier", "brand", "model", "cost_exw_usd")
    return back.select(*wide.columns).unionByName(wide)


@query(f"""WITH {OFFERS_SQL}, t AS ({_SUNK.format(K=K)} offers)) SELECT {K}, brand, CASE WHEN version_type <> '' THEN version_type END AS version, concat_ws(' | ', concat_ws(' ', supplier, brand, model), nullif(notes, '')) AS notes FROM t""")
def composite_payload(spark, sf_dir):
    """Payloads with a composite name and the version as an array, read back"""
    text_ = ("variant", "exterior_color", "interior_color", "location")
    rows = _sunk(spark, sf_dir).withColumn("id", F.struct(*KEY)).withColumns({c: F.lit(None).cast("string") for c in text_} | {c: F.lit(None).cast("long") for c in ("cost_fob_usd", "cost_fca_usd")})
    get = lambda p: F.get_json_object("record", p)
    return records.composite_payload(rows).select("id.*", get("$.brand").alias("brand"), get("$.version_type[0]").alias("version"), get("$.notes").alias("notes"))


@query(f"""WITH {OFFERS_SQL}, t AS ({_SUNK.format(K=K)} offers)) SELECT {K}, concat_ws(',', 'EXW美金价', CASE WHEN brand <> '' THEN '品牌' END, CASE WHEN version_type <> '' THEN '国际国内版本（多选）' END, CASE WHEN supplier <> '' THEN '供应商' END, CASE WHEN notes <> '' THEN '经验' END, CASE WHEN model <> '' THEN '型号' END) AS keys FROM t""")
def payload_keys(spark, sf_dir):
    """Which keys a payload has: allowed ones only, without blanks"""
    rows = _sunk(spark, sf_dir).withColumn("id", F.struct(*KEY)).withColumn("status", F.lit("pending"))
    order = F.array(*[F.lit(x) for x in ("EXW美金价", "品牌", "国际国内版本（多选）", "供应商", "经验", "型号")])
    keys = F.expr("json_object_keys(record)")
    named = F.concat(F.filter(order, lambda k: F.array_contains(keys, k)), F.array_except(keys, order))
    return records.sink_payload(rows).select("id.*", F.array_join(named, ",").alias("keys"))


_CSV_FILE = "(c_custkey - c_custkey % 10) // 10"


@query(f"""WITH t AS (SELECT *, {_CSV_FILE} AS f, 1 + row_number() OVER (PARTITION BY {_CSV_FILE} ORDER BY c_custkey) AS r FROM customer), w AS (
  SELECT f, 1 AS row_no, unnest([1, 2]) AS col_no, unnest(['车型', '地区,"x"']) AS value FROM t WHERE r = 2 UNION ALL SELECT f, r, unnest([1, 2]), unnest([c_name, CAST(c_nationkey AS VARCHAR)]) FROM t)
 SELECT 'S' || (f % 9) || '/' || f || '.csv' AS file, row_no, col_no, value FROM w WHERE f % 4 <> 3""")
def csv_files(spark, sf_dir):
    """Customers written as CSV files by supplier folder, found, fingerprinted, checked against a ledger of every
    fourth content, and read as cells"""
    c = table(spark, sf_dir, "customer").withColumn("f", F.expr("(c_custkey - c_custkey % 10) DIV 10"))
    line = F.concat(F.lit('"'), "c_name", F.lit('",'), F.col("c_nationkey").cast("string"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "\n")
    rows = c.groupBy("f").agg(F.concat(F.lit('车型,"地区,""x"""\n\n'), body).alias("content"))  # ten customers a file
    root = shared_folder(spark, "files")
    rows.select("content", (F.col("f") % 9).alias("s"), "f").repartition(8, "f").write.partitionBy("s", "f").option("lineSep", "\n").text(root)
    ledger = rows.where("f % 4 = 3").select(F.sha2(F.concat("content", F.lit("\n")), 256).alias("content_hash"))
    found = files.discover(spark, root, ("txt",)).withColumn("path", F.regexp_replace("path", "[.]txt$", ".csv"))
    good, _ = files.split_errors(files.read_cells(files.unseen(found, ledger)))
    name = F.concat(F.lit("S"), F.regexp_extract("path", "/s=(\\d+)/", 1), F.lit("/"), F.regexp_extract("path", "/f=(\\d+)/", 1), F.lit(".csv"))
    return good.select(name.alias("file"), "row_no", "col_no", "value")


@query("""WITH c AS (SELECT c_custkey % 9 AS k, row_number() OVER (PARTITION BY c_custkey % 9 ORDER BY c_custkey) AS r, * FROM customer),
  v AS (SELECT 9 + conv_id % 7 AS k, row_number() OVER (PARTITION BY conv_id % 7 ORDER BY conv_id, turn) AS r, * FROM conversations)
 SELECT k, r AS row_no, unnest([1, 2, 3, 4]) AS col_no, unnest([CAST(c_custkey AS VARCHAR), c_name || ' "x", ' || c_nationkey, '', c_mktsegment]) AS value FROM c
 UNION ALL SELECT k, r, unnest([1, 2, 3]), unnest([CAST(conv_id AS VARCHAR), replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), role]) FROM v""")
def csv_lines(spark, sf_dir):
    """A3: customers as CSV files of one record a line, with blank rows between, read line by line; turns of conversations as
    files whose fields hold line breaks, told apart and read whole"""
    root = shared_folder(spark, "csv")
    doubled = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 9).alias("k"), F.col("c_custkey").alias("a"), F.lit(0).alias("b"), F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), "c_name", F.lit(' ""x"", '), F.col("c_nationkey").cast("string"), F.lit('",,'), "c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, F.lit("\n,,\n")).otherwise("")).alias("value"))
    v = table(spark, sf_dir, "conversations").select((9 + F.col("conv_id") % 7).alias("k"), F.col("conv_id").alias("a"), F.col("turn").alias("b"), F.concat(F.col("conv_id").cast("string"), F.lit(","), doubled("text"), F.lit(","), "role").alias("value"))
    c.unionByName(v).repartition(8, "k").sortWithinPartitions("k", "a", "b").select("k", "value").write.partitionBy("k").text(root)
    good, _ = files.split_errors(csv_text.read_csv_cells(spark, root, ("txt",)))
    return good.select(F.regexp_extract("path", "/k=(\\d+)/", 1).cast("long").alias("k"), "row_no", "col_no", "value")


_BOOK = "SELECT o_orderkey, o_custkey % 20 AS f, o_orderdate, o_orderpriority, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS total, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) + 1 AS r FROM {orders}"
_AT = "CAST(o_orderdate AS TIMESTAMP) + INTERVAL (CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 86400 END) SECOND"


@query(f"""WITH o AS ({_duck(_BOOK, 'orders')}), cells AS (
  SELECT f, 'orders' AS sheet, 1 AS row_no, unnest([1, 2, 3]) AS col_no, 'orders of S' || f AS value, 's' AS kind, TRUE AS merged FROM o WHERE r = 2
  UNION ALL SELECT f, 'orders', r, 1, o_orderkey::VARCHAR, 'n', FALSE FROM o
  UNION ALL SELECT f, 'orders', r, 2, strftime({_AT}, '%Y-%m-%dT%H:%M:%S'), 'd', FALSE FROM o
  UNION ALL SELECT f, 'orders', r, 3, o_orderpriority || ' <&>', 's', FALSE FROM o
  UNION ALL SELECT f, 'orders', r, 4, ' ' || o_orderstatus, 's', FALSE FROM o WHERE o_orderkey % 5 <> 0
  UNION ALL SELECT f, 'orders', r, 5, total || '.5', 'n', FALSE FROM o
  UNION ALL SELECT f, 'orders', unnest([2, 3]), 6, (o_orderkey % 30) || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0') || ':00', 't', TRUE FROM o WHERE r = 2
  UNION ALL SELECT f, '旗', r - 1, 2, CASE WHEN total % 2 = 0 THEN 'True' ELSE 'False' END, 'b', FALSE FROM o)
  SELECT 'S' || f || '.xlsx' AS file, sheet, row_no, col_no, value, kind, merged, CASE WHEN kind = 'd' THEN substr(value, 1, 10) END AS day FROM cells""")
def workbook_cells(spark, sf_dir):
    """Orders written as workbooks (shared and inline text, numbers, dates with and without a time, durations,
    booleans, merged ranges over columns and rows) and read back as cells; date cells are dates"""
    o = view(spark, sf_dir, _BOOK, "orders")
    at = F.date_format(F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.when(F.expr("o_orderkey % 2 = 0"), 0).otherwise(F.expr("o_orderkey % 86400"))), "yyyy-MM-dd'T'HH:mm:ss")
    key = F.col("o_orderkey").cast("string")
    lasts = F.concat((F.col("o_orderkey") % 30).cast("string"), F.lit(":"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"), F.lit(":00"))
    cell = lambda sheet, r, c, value, kind: F.struct(F.lit(sheet).alias("sheet"), F.lit(1 if sheet == "orders" else 2).alias("sheet_no"), r.alias("row_no"), F.lit(c).alias("col_no"), value.alias("value"), F.lit(kind).alias("kind"))
    r = F.col("r").cast("int")
    made = F.array(
        cell("orders", F.lit(1), 1, F.when(r == 2, F.concat(F.lit("orders of S"), F.col("f").cast("string"))), "s"),
        cell("orders", r, 1, key, "n"), cell("orders", r, 2, at, "d"), cell("orders", r, 3, F.concat("o_orderpriority", F.lit(" <&>")), "s"),
        cell("orders", r, 4, F.when(F.expr("o_orderkey % 5 <> 0"), F.concat(F.lit(" "), "o_orderstatus")), "i"), cell("orders", r, 5, F.concat(F.col("total").cast("string"), F.lit(".5")), "n"),
        cell("orders", r, 6, F.when(r == 2, lasts), "t"), cell("旗", r + 3, 2, F.when(F.expr("total % 2 = 0"), "True").otherwise("False"), "b"),
    )
    path = F.concat(F.lit("/input/S"), F.col("f").cast("string"), F.lit(".xlsx"))
    cells = o.select(path.alias("path"), F.explode(made).alias("c")).select("path", "c.*")
    merges = o.select(path.alias("path")).distinct().select("path", F.lit("orders").alias("sheet"), F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("min_row", "max_row", "min_col", "max_col"), m)]) for m in ((1, 1, 1, 3), (2, 3, 6, 6))])).alias("m")).select("path", "sheet", "m.*")
    books = workbooks.to_workbooks(cells, merges).withColumn("length", F.length("content"))
    good, _ = files.split_errors(files.read_cells(files.fingerprinted(books)))
    return good.select(F.regexp_extract("path", "[^/]*$", 0).alias("file"), "sheet", "row_no", "col_no", "value", "kind", "merged", F.when(F.col("kind") == "d", dates.normal_date(F.col("value"))).alias("day"))


@query(f"""WITH {OFFERS_SQL}, m AS (SELECT supplier, l_partkey, (min((l_orderkey % 3 <> 0, l_orderkey, l_linenumber))) AS o FROM offers GROUP BY 1, 2),
  n AS (SELECT supplier, l_partkey, 'MDL-' || lpad((64 + row_number() OVER (ORDER BY o, supplier, l_partkey::VARCHAR))::VARCHAR, greatest(3, length((64 + row_number() OVER (ORDER BY o, supplier, l_partkey::VARCHAR))::VARCHAR))::INT, '0') AS model_id FROM m),
  v AS (SELECT model_id, l_linenumber % 3 AS variant, min((l_orderkey % 3 <> 0, l_orderkey, l_linenumber)) AS o FROM offers JOIN n USING (supplier, l_partkey) GROUP BY 1, 2)
  SELECT supplier, l_partkey, variant, model_id || '-V' || lpad(row_number() OVER (PARTITION BY model_id ORDER BY o, variant)::VARCHAR, 2, '0') AS variant_id FROM n JOIN v USING (model_id)""")
def durable_ids_in_two_runs(spark, sf_dir):
    """models and variants of offers get their ids in a run over a third of the orders, in a run over all of them, and
    in a repetition of that; every id is the one of the first run that met its key"""
    store = jobs.Store(spark, shared_folder(spark, "store"))
    numbering = jobs.numbering(store)
    hashed = lambda df, *keys: df.withColumn("_hash", F.xxhash64(*keys))  # noqa: E731  (texts that begin alike are slow to sort)
    o = written(offers(spark, sf_dir).select("supplier", F.col("l_partkey").cast("string").alias("part"), "l_orderkey", "l_linenumber", (F.col("l_linenumber") % 3).cast("string").alias("variant"), F.struct("l_orderkey", "l_linenumber").alias("ord")), "offers")
    for seen in (o.where("l_orderkey % 3 = 0"), o, o):
        models = numbering.models(seen, ["supplier", "part"], "ord").withColumnRenamed("id", "model_id")
        named = hashed(seen, "supplier", "part").join(hashed(models, "supplier", "part"), ["_hash", "supplier", "part"]).drop("_hash")
        variants = numbering.variants(named, "model_id", "variant", "ord")
    return hashed(models, "model_id").join(hashed(variants, "model_id"), ["_hash", "model_id"]).select("supplier", F.col("part").cast("long").alias("l_partkey"), F.col("variant").cast("long").alias("variant"), F.col("id").alias("variant_id"))


_TOLD = "concat(p_name, ' ', CAST(p_partkey * 7919 AS VARCHAR(20)), CASE WHEN p_partkey % 3 = 0 THEN concat(' 车型', CAST(p_size AS VARCHAR(9))) ELSE '' END)"
_PATTERNS = "SELECT o_orderkey AS prio, CASE CAST(o_orderkey % 50 AS INT) WHEN 1 THEN concat('车型', CAST(o_orderkey % 60 AS VARCHAR(9))) ELSE CAST(o_orderkey AS VARCHAR(20)) END AS pattern, concat('rule ', CAST(o_orderkey AS VARCHAR(20))) AS named FROM {orders}"


@query(f"""WITH r AS ({_duck(_PATTERNS, 'orders')}), k AS (SELECT p_partkey, {_TOLD} AS told FROM part), hit AS (SELECT p_partkey, arg_min(named, prio) AS named FROM k JOIN r ON contains(told, pattern) GROUP BY p_partkey)
  SELECT p_partkey, told, named FROM k LEFT JOIN hit USING (p_partkey)""")
def rule_index(spark, sf_dir):
    """A rule for each order, found inside texts of parts by an index of character runs: no text meets every rule"""
    k = table(spark, sf_dir, "part").select("p_partkey", F.expr(_TOLD.replace("VARCHAR(20)", "STRING").replace("VARCHAR(9)", "STRING")).alias("told"))
    r = spark.sql(_PATTERNS.replace("VARCHAR(20)", "STRING").replace("VARCHAR(9)", "STRING"), orders=table(spark, sf_dir, "orders"))
    return matching.first_match_join(k, ["told"], r, lambda: F.col("told").contains(F.col("pattern")), ["named"], within=[(["told"], F.col("pattern"))], most=0, reads=["pattern"])


_CHANGED = """CASE WHEN id % 1000 = 7 THEN NULL WHEN id % 10 = 3 AND round_ >= 2 THEN concat('again ', CAST(id AS VARCHAR(20))) WHEN id % 5 = 3 THEN concat('edit ', CAST(id AS VARCHAR(20))) ELSE model END"""


@query(f"""WITH b AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderpriority AS model, CAST(floor(o_totalprice) AS BIGINT) AS qty FROM orders), r(round_) AS (VALUES (1), (2), (3))
 SELECT round_, id, {_CHANGED.replace("id % 1000 = 7", "id % 1000 = 7 AND round_ >= 2")} AS model, CASE WHEN id % 5 = 3 AND round_ >= 2 AND id % 10 = 3 THEN NULL ELSE qty END AS qty FROM b, r WHERE NOT (id % 7 = 1 AND round_ >= 2)""")
def edits_at_read(spark, sf_dir):
    """Staged orders with edits and deletes that are merged when the table is read: after the first edits, after more
    of them (later ones win, a value is cleared, a text that is no number clears one) and deletes, and after they have been
    written into a new version"""
    store = jobs.Store(spark, shared_folder(spark, "changes"))
    schema = "id long, model string, qty long"
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("model"), F.floor("o_totalprice").cast("long").alias("qty"))
    store.replace("t", staging.with_ids(o, 0, ["o_orderkey"]).select("id", "model", "qty"))
    ids = store.read("t", schema).select("id")
    edit = lambda where, key, value: ids.where(where).select("id", F.lit(key).alias("key"), value.alias("value"))
    text = lambda word: F.concat(F.lit(f"{word} "), F.col("id").cast("string"))
    store.change("t", schema, lambda n: deltas.edit_changes(edit("id % 5 = 3", "model", text("edit")), n))
    first = written(store.read("t", schema), "round")
    later = edit("id % 10 = 3", "model", text("again")).unionByName(edit("id % 10 = 3", "qty", F.lit("none"))).unionByName(edit("id % 1000 = 7", "model", F.lit(None).cast("string")))
    store.change("t", schema, lambda n: deltas.edit_changes(later, n))
    store.change("t", schema, lambda n: deltas.drop_changes(ids.where("id % 7 = 1"), n))
    second = written(store.read("t", schema), "round")
    store.change("t", schema, lambda n: deltas.edit_changes(edit("id = -1", "model", F.lit("nobody")), n), most=4)
    out = None
    for i, t in enumerate((first, second, store.read("t", schema)), 1):
        t = t.select(F.lit(i).alias("round_"), "id", "model", "qty")
        out = t if out is None else out.unionByName(t)
    return out


@query("""WITH e AS (SELECT *, lag(event_type) OVER w AS t, lag(CAST(floor(value) AS BIGINT)) OVER w AS v, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
 SELECT user_id, event_id, 'event_type' AS field, t AS old_value, event_type AS new_value FROM e WHERE n > 1 AND event_id % 5 <> 0 AND t IS DISTINCT FROM event_type
 UNION ALL SELECT user_id, event_id, 'value', CAST(v AS VARCHAR), CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) FROM e WHERE n > 1 AND event_id % 5 <> 0 AND v IS DISTINCT FROM CAST(floor(value) AS BIGINT)""")
def stream_versions(spark, sf_dir):
    """Events as versions of their users, in three files that are three batches; each version is compared with the one
    before it, in whichever batch that was; every fifth is not approved"""
    versions.use_state_store(spark)
    root = shared_folder(spark, "versions")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.concat(F.lit(" "), "event_type").alias("event_type"), F.floor("value").cast("long").alias("value"))
    third = e.agg(F.max("event_id")).first()[0] // 3 + 1
    for i in range(3):
        e.where(F.floor(F.col("event_id") / third) == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    feed = versions.version_changes(source, "user_id", "event_id", ["event_type", "value"], F.col("event_id") % 5 != 0)
    feed.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).format("parquet").option("path", f"{root}/out").start().awaitTermination()
    out = spark.read.schema(versions.CHANGE).parquet(f"{root}/out")
    return out.select(F.col("key").cast("long").alias("user_id"), F.col("ord").cast("long").alias("event_id"), "field", "old_value", "new_value")


@query("""SELECT 'part_no=' || (s_suppkey % 6) AS supplier, 'BYD' AS brand, CASE WHEN s_suppkey % 2 = 0 THEN 'Dolphin' ELSE 'Seagull' END AS model, 9000 + s_suppkey AS cost_exw_usd, 'pending' AS status, true AS in_ledger FROM supplier""")
def stream_store(spark, sf_dir):
    """Price sheets of suppliers as a stream of files, in two batches through the whole normalisation into
    the staged table and the ledger; the first batch is run twice and changes nothing the second time"""
    root = shared_folder(spark, "stream")
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 6).alias("part_no"), F.lit("BYD").alias("品牌"), F.when(F.col("s_suppkey") % 2 == 0, "海豚").otherwise("Seagull").alias("车型"), F.concat(F.lit("$"), (F.lit(9000) + F.col("s_suppkey")).cast("string")).alias("EXW"))
    s.repartition(6, "part_no").write.partitionBy("part_no").option("header", True).csv(f"{root}/input")
    store = jobs.Store(spark, f"{root}/tables")
    write = jobs.ingest(store, now=F.lit("2026-01-02").cast("timestamp"))

    def twice(batch: DataFrame, number: int) -> None:
        write(batch, number)
        if number == 0:
            write(batch, number)

    streams.run_available(streams.new_files(spark, f"{root}/input", 3), f"{root}/checkpoint", twice).awaitTermination()
    staged, ledger = store.read("staged", registry.staged_schema()), store.read("ledger", jobs.LEDGER)
    known = ledger.select("content_hash").withColumn("in_ledger", F.lit(True))
    return staged.join(known, "content_hash", "left").select("supplier", "brand", "model", "cost_exw_usd", "status", F.coalesce("in_ledger", F.lit(False)).alias("in_ledger"))


@query("""WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders WHERE o_orderkey % 4 <> 0)
 SELECT CAST(floor((i - 1) / 100) AS BIGINT) AS batch_no, count(*) AS n, count(*) FILTER (o_orderkey % 7 = 0) AS n_empty, count(*) AS n_synced FROM o GROUP BY 1""")
def sync_outcomes(spark, sf_dir):
    """Pending orders published in batches of 100, a protected target refused; rows and empty records of
    each batch, and how many of its rows are marked synced in the staged table"""
    root = shared_folder(spark, "sync")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.expr("o_orderkey % 7 <> 0"), F.col("o_orderpriority")).alias("supplier"), F.when(F.expr("o_orderkey % 4 = 0"), "synced").otherwise("pending").alias("status"))
    store = jobs.Store(spark, f"{root}/tables")
    staged = staging.with_ids(o, 0, ["o_orderkey"]).drop("o_orderkey")
    store.replace("staged", staging.evolve(spark.createDataFrame([], registry.staged_schema()), staged))
    target, now = f"{root}/payload", F.lit("2026-01-02 03:04:05").cast("timestamp")
    try:
        jobs.sync(store, target, now, protected=(target,))
        raise AssertionError("a protected target was written to")
    except PermissionError:
        outcome = jobs.sync(store, target, now)
    marked = store.read("staged", registry.staged_schema()).where("status = 'synced'").select("id")
    synced = spark.read.parquet(target).join(marked, "id", "left_semi").groupBy("batch_no").agg(F.count("*").alias("n_synced"))
    return outcome.join(synced, "batch_no", "left").select("batch_no", "n", "n_empty", F.coalesce("n_synced", F.lit(0).cast("long")).alias("n_synced"))


@query("""WITH p AS (SELECT p_partkey, 'old ' || p_brand AS old, 'new ' || p_brand || '-' || p_size AS new FROM part WHERE p_partkey % 3 = 0)
 SELECT 'model' AS field, old AS raw_pattern, arg_max(new, p_partkey) AS target_value, arg_min(p_partkey, p_partkey)::VARCHAR AS context FROM p GROUP BY old""")
def harvest_rules(spark, sf_dir):
    """Approved edits of parts against the newest of two snapshots become stored rules: of each old value the
    last target, with the first record that told it; harvested twice, they stay as they are"""
    p = table(spark, sf_dir, "part")
    old = p.select(F.col("p_partkey").alias("record_id"), F.concat(F.lit("old "), "p_brand").alias("model"), F.lit(2).alias("snapshot_ts"))
    now = p.select(F.col("p_partkey").alias("record_id"), F.concat(F.lit("new "), "p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("model"), F.when(F.expr("p_partkey % 3 = 0"), "已通过").otherwise("pending").alias("state"))
    snapshots = old.unionByName(old.withColumn("model", F.lit("older")).withColumn("snapshot_ts", F.lit(1)))
    store = jobs.Store(spark, shared_folder(spark, "harvest"))
    for _ in range(2):
        jobs.harvest(store, now, snapshots, "state", F.lit(3))
    return store.read("rules", jobs.RULES).select("field", "raw_pattern", "target_value", "context")


@query("""SELECT c_custkey, c_name AS supplier, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS notes, c_nationkey AS qty FROM customer""")
def json_sink(spark, sf_dir):
    """Customers written as JSON lines, twice over, and read again; blanks stay out"""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("supplier"), F.when(F.expr("c_custkey % 3 <> 0"), F.col("c_mktsegment")).alias("notes"), F.col("c_nationkey").cast("long").alias("qty"))
    path = shared_folder(spark, "json")
    records.write_json(rows.limit(1), path)
    records.write_json(rows, path)
    return records.read_json_array(spark, path, rows.schema)


@query("""SELECT 'N' || c_nationkey || '.xlsx' AS file, c_nationkey % 3 = 0 AS bad, CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE count(*) END AS n_cells FROM customer GROUP BY c_nationkey""")
def bad_files(spark, sf_dir):
    """Customers as a workbook for each nation, every third of them cut short: a damaged file is an error and gives no cells,
    the others are read"""
    c = table(spark, sf_dir, "customer")
    cells = c.select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit(".xlsx")).alias("path"), F.lit("s").alias("sheet"), F.lit(1).alias("sheet_no"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).alias("row_no"), F.lit(1).alias("col_no"), F.col("c_name").alias("value"), F.lit("s").alias("kind"))
    books = workbooks.to_workbooks(cells).withColumn("n", F.regexp_extract("path", "[0-9]+", 0).cast("int"))
    cut = F.when(F.expr("n % 3 = 0"), F.expr("substring(content, 1, length(content) DIV 2)")).otherwise(F.col("content"))
    read = files.read_cells(files.fingerprinted(books.withColumn("content", cut).withColumn("length", F.length("content"))))
    return read.groupBy(F.col("path").alias("file")).agg(F.max(F.col("error").isNotNull()).alias("bad"), F.count("value").alias("n_cells"))


@query("""WITH r AS (SELECT s_name AS pattern, 'fixed-' || s_suppkey AS target, 'model' AS field FROM supplier WHERE s_suppkey % 2 = 0)
 SELECT c_custkey, coalesce(r.target, x.n) AS model, c_mktsegment FROM (SELECT c_custkey, replace(c_name, 'Customer', 'Supplier') AS n, c_mktsegment FROM customer) x LEFT JOIN r ON x.n = r.pattern""")
def learned_overrides(spark, sf_dir):
    """Rules distilled from edits of suppliers' names, applied to customers"""
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0")
    edits = s.select(F.lit("model").alias("field"), F.concat(F.lit(" "), "s_name").alias("old_value"), F.concat(F.lit("fixed-"), F.col("s_suppkey").cast("string")).alias("new_value"), F.lit(None).cast("string").alias("context"), F.col("s_suppkey").alias("ord"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("model"), "c_mktsegment")
    return changes.apply_overrides(c, changes.distil(edits), ["model"])


@query("""SELECT p_partkey, coalesce('of ' || p_brand, NULL) AS brand_en FROM (SELECT p_partkey, p_brand FROM part)""")
def rules_file(spark, sf_dir):
    """A10: rules read from a JSON rules file made of the parts' brands, used as a first-match table"""
    path = shared_folder(spark, "rules")
    p = table(spark, sf_dir, "part")
    brands = F.map_from_entries(F.array_sort(F.collect_set(F.struct("p_brand", F.concat(F.lit("of "), "p_brand").alias("v")))))
    p.agg(F.to_json(F.struct(brands.alias("brands"))).alias("value")).coalesce(1).write.text(path)
    loaded = rules.load_rules(spark, path, "brands", rules.brand_names(spark))
    names = loaded.select("prio", F.col("key").alias("zh"), F.col("value").alias("en"))
    exact = F.concat(F.lit("["), "p_brand", F.lit("]"))
    return matching.translate_brand(p.select("p_partkey", exact.alias("b")), "b", names.withColumn("zh", F.concat(F.lit("["), "zh", F.lit("]")))).select("p_partkey", "brand_en")


_OVERRIDE = "SELECT DISTINCT p_brand AS raw_brand, p_type AS raw_model, concat('B ', p_brand) AS brand, CASE WHEN p_type LIKE '%E%' THEN '' ELSE concat('M ', p_type) END AS model FROM {part}"


@query(f"""WITH {_RULES}, o AS ({_duck(_OVERRIDE, 'part')}) SELECT raw_brand, raw_model, brand, model FROM r UNION ALL SELECT lower(raw_brand), lower(raw_model), brand, model FROM o WHERE model <> ''""")
def model_overrides(spark, sf_dir):
    """The built-in map with rows of a sheet of parts over it; incomplete rows are left out"""
    return rules.brand_models(spark, view(spark, sf_dir, _OVERRIDE, "part")).select("raw_brand", "raw_model", "brand", "model")


@query("""SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS batch, CASE WHEN event_id % 2 = 0 THEN user_id END AS user_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events""")
def batch_stamps(spark, sf_dir):
    """Events stamped by second, in two halves of different columns put together"""
    e = table(spark, sf_dir, "events").withColumn("batch", staging.batch_id(F.col("ts")))
    return staging.evolve(e.where("event_id % 2 = 0").select("event_id", "batch", "user_id"), e.where("event_id % 2 = 1").select("event_id", "batch", "event_type"))


@query(f"""WITH {OFFERS_SQL} SELECT 100 + row_number() OVER (ORDER BY {K}) AS id, supplier, raw_brand AS brand, raw_model AS model, CAST(NULL AS BIGINT) AS cost_exw_usd, 'pending' AS status FROM offers""")
def stage_append(spark, sf_dir):
    """Offers staged in their order with consecutive ids, and read as pending rows"""
    o = offers(spark, sf_dir).select(*KEY, "supplier", F.col("raw_brand").alias("brand"), F.col("raw_model").alias("model"))
    staged = staging.stage(o, 100, F.lit("2026-01-01").cast("timestamp"), list(KEY))
    return staging.pending(staged).select("id", "supplier", "brand", "model", "cost_exw_usd", "status")


@query("SELECT o_orderkey, floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 500)::BIGINT AS batch_no FROM orders")
def batches(spark, sf_dir):
    """orders numbered without a window over them, in batches of 500"""
    rows = staging.with_ids(table(spark, sf_dir, "orders").select("o_orderkey"), 0, ["o_orderkey"])
    return staging.batches(rows, 500).select("o_orderkey", "batch_no")


@query("""SELECT 's' || (user_id % 5) || '-' || event_type AS name, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1""")
def stream_ingest(spark, sf_dir):
    """Files of events, some of them twice, as a stream; each content is staged once, then entered in the ledger"""
    root = shared_folder(spark, "landing")
    e = table(spark, sf_dir, "events").select(F.concat(F.col("event_type"), F.lit(","), F.col("event_id").cast("string")).alias("line"), (F.col("user_id") % 5).alias("s"), F.col("event_type").alias("t"))
    once = e.repartition("s", "t").sortWithinPartitions("s", "t", "line")
    once.write.partitionBy("s", "t").csv(f"{root}/a")
    once.where("s = 1").write.partitionBy("s", "t").csv(f"{root}/b")
    lines = lambda b: b.select(F.regexp_extract("path", "/s=(\\d+)/", 1).alias("s"), F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where("line <> ''")
    write = streams.stage_then_ledger(lines, f"{root}-staged", f"{root}-ledger")
    streams.run_available(streams.once_by_content(streams.new_files(spark, root, 7)), f"{root}-checkpoint", write).awaitTermination()
    staged = spark.read.option("basePath", f"{root}-staged").parquet(f"{root}-staged/batch=*")
    parts = F.split(F.regexp_replace("line", '["\\\\]', ""), ",")
    return staged.groupBy(F.concat(F.lit("s"), "s", F.lit("-"), parts[0]).alias("name")).agg(F.count("*").alias("n"), F.sum(parts[1].cast("long")).alias("total"))


@query("""SELECT event_type, count(*) AS scanned, count(*) FILTER (user_id % 3 = 0) AS approved, count(*) FILTER (user_id % 3 <> 0) AS skipped FROM events GROUP BY event_type""")
def harvest_counters(spark, sf_dir):
    """Scanned, approved and skipped records by kind"""
    e = table(spark, sf_dir, "events").withColumn("state", F.when(F.expr("user_id % 3 = 0"), F.concat(F.lit(" 审核"), F.lit("通过 "))).otherwise(F.when(F.expr("user_id % 3 = 1"), "pending")))
    return changes.harvest_counts(e, state.is_approved(F.array("state")), ["event_type"])


_NESTED = """concat('{{"confidence":', CAST(k AS VARCHAR(9)), ',"a":[{{"s\\\\u0063ore":', CAST(k * 2 AS VARCHAR(9)), ',"note":"\\\\"confidence\\\\": 900"}},[{{"b":{{"prob":', CAST(event_id % 7 AS VARCHAR(9)), ',"confidence":"high"}}}}]],"scores":1}}')"""


@query("""SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 1.0 ELSE (k + k * 2 + event_id % 7) / 3.0::DOUBLE END AS confidence FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def json_walk(spark, sf_dir):
    """Numbers under confidence, score and prob at several depths; texts that look like them do not count"""
    k = F.get_json_object("props", "$.k").cast("long")
    e = table(spark, sf_dir, "events").select("event_id", k.alias("k"))
    nested = F.expr(_NESTED.replace("{{", "{").replace("}}", "}").replace("VARCHAR(9)", "STRING"))
    return e.select("event_id", state.json_confidence(F.when(F.expr("event_id % 5 = 4"), F.lit('{"scores":1,"a":["confidence"]}')).otherwise(nested)).alias("confidence"))


# ---- the whole normalisation

_PART = r"^(\d+)\s*([\x{4e00}-\x{9fa5}A-Za-z]+)(?:/([\x{4e00}-\x{9fa5}A-Za-z]+))?$"
_BRAND = "CASE raw_brand WHEN '比亚迪' THEN 'BYD' WHEN 'BYD' THEN 'BYD' WHEN '吉利' THEN 'Geely' WHEN '极氪' THEN 'Zeekr' WHEN '小米' THEN 'Xiaomi' WHEN '方程豹' THEN 'Fangchengbao' WHEN '五菱' THEN 'Wuling' WHEN '零跑' THEN 'Leapmotor' WHEN '广汽埃安' THEN 'GAC' WHEN '问界' THEN 'AITO' END"
_MODEL = "CASE raw_model WHEN '海豚' THEN 'Dolphin' WHEN '银河 E5' THEN 'Galaxy E5' WHEN '豹5' THEN 'Leopard 5' WHEN 'LZW6470X' THEN 'Starlight S' ELSE nullif(raw_model, '') END"
_TERM = "upper(regexp_extract(location_text, '(?i)(FCA|FOB|EXW)', 1))"

#: The offers have a brand, a model, an EXW price text, a place, a colour, a waiting time and a quantity; see ``candidates_full``.
CANDIDATES = f"""WITH {OFFERS_SQL}, r AS (SELECT {K}, supplier, qty, colour_text, wait_text, location_text, {_BRAND} AS brand, {_MODEL} AS model, {NUM('price_text')} AS p, price_text FROM offers),
 k AS (SELECT * FROM r WHERE brand IS NOT NULL AND model IS NOT NULL),
 ids AS (SELECT brand, model, 'MDL-' || lpad(i, greatest(length(i), 3)::INT, '0') AS model_id FROM (SELECT brand, model, CAST(64 + row_number() OVER (ORDER BY o) AS VARCHAR) AS i FROM (SELECT brand, model, min(({K})) AS o FROM k GROUP BY brand, model))),
 c AS (SELECT *, CASE WHEN p IS NULL THEN FALSE WHEN regexp_matches(price_text, '(?i)人民币|RMB|CNY|¥|￥') THEN TRUE WHEN regexp_matches(price_text, '(?i)美金|美元|USD|[$]') THEN FALSE ELSE p >= 35000 END AS cny FROM k),
 u AS (SELECT *, CASE WHEN cny THEN {USD('p')} ELSE p END AS usd, CASE WHEN cny THEN p END AS guide, {_TERM} AS term,
   CASE location_text WHEN 'FCA南沙港' THEN '南沙' WHEN '广州南沙' THEN '南沙' WHEN 'FOB上海' THEN '上海' WHEN '霍尔果斯综合保税区' THEN '霍尔果斯' END AS place,
   CASE colour_text WHEN '110白' THEN '白' WHEN '白/黑' THEN '白' WHEN '/' THEN NULL ELSE colour_text END AS e, CASE colour_text WHEN '白/黑' THEN '黑' END AS inner_ FROM c),
 b AS (SELECT *, CASE WHEN usd >= 1000 AND usd < 200000 THEN usd END AS price FROM u),
 s AS (SELECT *, coalesce(regexp_matches(e, '[+;；、]'), FALSE) AS many, CASE WHEN regexp_matches(e, '[+;；、]') THEN string_split_regex(e, '[+；;、]') ELSE [e] END AS parts FROM b),
 x AS (SELECT * EXCLUDE (parts), unnest(parts) AS part, generate_subscripts(parts, 1) AS split_no FROM s),
 f AS (SELECT {K}, split_no, supplier, brand, model, place, guide, wait_text, CASE WHEN term NOT IN ('FCA', 'FOB') THEN price END AS exw, CASE WHEN term = 'FCA' THEN price END AS fca, CASE WHEN term = 'FOB' THEN price END AS fob,
   CASE WHEN many AND regexp_matches(part, '{_PART}') THEN CAST(regexp_extract(part, '{_PART}', 1) AS BIGINT) ELSE qty END AS stock, CASE WHEN many AND regexp_matches(part, '{_PART}') THEN regexp_extract(part, '{_PART}', 2) ELSE part END AS ext,
   CASE WHEN many AND regexp_matches(part, '{_PART}') THEN nullif(regexp_extract(part, '{_PART}', 3), '') ELSE inner_ END AS int_ FROM x),
 once AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY supplier, brand, model, coalesce(ext, ''), coalesce(int_, ''), stock, guide, exw, fob, fca, coalesce(place, '') ORDER BY {K}, split_no) = 1),
 bare AS (SELECT *, coalesce(guide, exw, fob, fca) IS NULL AND ext IS NULL AS is_bare FROM once),
 folded AS (SELECT * FROM bare QUALIFY NOT is_bare OR row_number() OVER (PARTITION BY is_bare, supplier, brand, model ORDER BY {K}, split_no) = 1)
 SELECT {K}, CAST(split_no - 1 AS INT) AS split_no, supplier, brand, model, model_id, CASE WHEN wait_text = '现车' THEN '现车' WHEN wait_text = '' THEN '无具体信息' ELSE '在途' END AS status_vehicle, place AS location, guide AS supplier_price_cny,
  exw AS cost_exw_usd, fca AS cost_fca_usd, fob AS cost_fob_usd, stock AS stock_quantity, ext AS exterior_color, int_ AS interior_color
 FROM folded JOIN ids USING (brand, model)"""
query(CANDIDATES)(candidates_full)
