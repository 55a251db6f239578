"""Registered queries: each applies an operator to the driver tables; most have a DuckDB statement of the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed, rules
from ..functions import color, dates, location, numbers, price, state, text, variant
from ..materialize import written
from ..operators import candidates, changes, grid, identity, matching, staging, validation
from ..sources import records
from ..streaming import jobs
from .offers import KEY, OFFERS
from .offers import SQL as OFFERS_SQL

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
K = ", ".join(KEY)


def query(sql: str | None = None):
    def add(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"query {f.__name__} is registered twice")
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OFFERS, **{t: table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier")})


def values(rows) -> str:
    """Rows as SQL VALUES."""
    q = lambda v: str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(map(q, r)) + ")" for r in rows)


NUM = lambda x: f"CAST(round_even(TRY_CAST(nullif(regexp_replace({x}, '[^0-9.]', '', 'g'), '') AS DOUBLE), 0) AS BIGINT)"
USD = lambda x: f"CAST(round_even({x} / 6.7::DOUBLE, 0) AS BIGINT)"


# ---- scalar functions


@query(f"WITH {OFFERS_SQL} SELECT {K}, {NUM('price_text')} AS price FROM offers")
def to_number(spark, sf_dir):
    """C1"""
    return offers(spark, sf_dir).select(*KEY, numbers.to_number(F.col("price_text")).alias("price"))


_ORDER_DATE = """CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN concat(CAST(year(o_orderdate) + 20 AS VARCHAR(4)), '年', CAST(month(o_orderdate) AS VARCHAR(2)), '月', CAST(day(o_orderdate) AS VARCHAR(2)), '日')
 WHEN 1 THEN concat(CAST(year(o_orderdate) + 20 AS VARCHAR(4)), '-', CAST(month(o_orderdate) AS VARCHAR(2))) WHEN 2 THEN concat(CAST(year(o_orderdate) + 20 AS VARCHAR(4)), '/', CAST(month(o_orderdate) AS VARCHAR(2)), '/', CAST(day(o_orderdate) AS VARCHAR(2)))
 ELSE concat('x', CAST(o_orderkey AS VARCHAR(20))) END"""
_DAY, _MONTH = r"(20\d{2})[年./-](\d{1,2})[月./-](\d{1,2})(?:日|$)", r"(20\d{2})\D{0,3}(\d{1,2})"
_NORMAL = f"""CASE WHEN regexp_matches(t, '{_DAY}') THEN regexp_extract(t, '{_DAY}', 1) || '-' || lpad(regexp_extract(t, '{_DAY}', 2), 2, '0') || '-' || lpad(regexp_extract(t, '{_DAY}', 3), 2, '0')
 WHEN regexp_matches(t, '{_MONTH}') THEN regexp_extract(t, '{_MONTH}', 1) || '-' || lpad(regexp_extract(t, '{_MONTH}', 2), 2, '0') || '-01' END"""


@query(f"SELECT o_orderkey, {_NORMAL} AS day, epoch_ms(try_strptime({_NORMAL}, '%Y-%m-%d')) AS millis FROM (SELECT o_orderkey, {_ORDER_DATE} AS t FROM orders)")
def date_normalise(spark, sf_dir):
    """C2, C3"""
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_ORDER_DATE).alias("t"))
    return t.select("o_orderkey", dates.normal_date(F.col("t")).alias("day"), dates.epoch_millis(F.col("t")).alias("millis"))


_YM = r"(20\d{2})[年./-](\d{1,2})"


@query(f"""SELECT o_orderkey, coalesce(TRY_CAST(regexp_extract(t, '{_YM}', 1) AS BIGINT), TRY_CAST(regexp_extract(t, '(20\\d{{2}})', 1) AS BIGINT)) AS year, TRY_CAST(regexp_extract(t, '{_YM}', 2) AS BIGINT) AS month
 FROM (SELECT o_orderkey, {_ORDER_DATE} AS t FROM orders)""")
def year_month(spark, sf_dir):
    """C4"""
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_ORDER_DATE).alias("t"))
    none = F.lit(None).cast("string")
    made = dates.manufacture_year_month([none], [none], [F.col("t")])
    return t.select("o_orderkey", made["year"].alias("year"), made["month"].alias("month"))


_WAIT = """CASE wait_text WHEN '现车' THEN 0 WHEN '2-3周' THEN 21 WHEN '45天' THEN 45 WHEN '1个月' THEN 30 WHEN '42' THEN 42 END"""


@query(f"""WITH {OFFERS_SQL} SELECT {K}, CAST(CASE WHEN regexp_matches(wait_text, '现车') THEN 0
 WHEN regexp_matches(wait_text, '(\\d+)-(\\d+)周') THEN 7 * CAST(regexp_extract(wait_text, '(\\d+)-(\\d+)周', 2) AS INT) WHEN regexp_matches(wait_text, '(\\d+)个月') THEN 30 * CAST(regexp_extract(wait_text, '(\\d+)个月', 1) AS INT)
 WHEN regexp_matches(wait_text, '(\\d+)天') THEN CAST(regexp_extract(wait_text, '(\\d+)天', 1) AS INT) WHEN regexp_matches(wait_text, '^\\d+$') THEN CAST(wait_text AS INT) END AS BIGINT) AS days FROM offers""")
def wait_days(spark, sf_dir):
    """C5"""
    return offers(spark, sf_dir).select(*KEY, numbers.wait_days(F.col("wait_text")).alias("days"))


@query("SELECT p_partkey, trim(replace(replace(replace('EXW价格表 ' || p_name || ' 2025款.xlsx', 'EXW价格表', ''), '2025款', ''), '.xlsx', ''), ' _-.' || chr(10) || chr(13)) AS clean, lower(regexp_replace(p_name || '-' || p_type, '[\\s_\\-/：:]+', '', 'g')) AS compact FROM part")
def noise_strip(spark, sf_dir):
    """C9, C14"""
    p = table(spark, sf_dir, "part")
    noisy = F.concat(F.lit("EXW价格表 "), "p_name", F.lit(" 2025款.xlsx"))
    return p.select("p_partkey", text.clean_noise(noisy).alias("clean"), text.compact_key(F.concat_ws("-", "p_name", "p_type")).alias("compact"))


@query("""SELECT doc_id, pos, line = '' OR length(trim(line)) > 40 OR regexp_matches(trim(line), '^\\d+[.、\\s]|(?i)汇率|说明|提示') AS invalid
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)""")
def footer_lines(spark, sf_dir):
    """C10 over the lines of documents"""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return d.select("doc_id", F.col("pos").cast("long").alias("pos"), text.is_invalid_model(F.col("line")).alias("invalid"))


# ---- prices

_CNY = "CASE WHEN regexp_matches(price_text, '(?i)人民币|RMB|CNY|¥|￥') THEN TRUE WHEN regexp_matches(price_text, '(?i)美金|美元|USD|[$]') THEN FALSE ELSE coalesce(price >= 35000, FALSE) END"
_PRICED = f"priced AS (SELECT *, {NUM('price_text')} AS price FROM offers), judged AS (SELECT *, CASE WHEN price IS NULL THEN FALSE ELSE {_CNY} END AS cny FROM priced)"


@query(f"WITH {OFFERS_SQL}, {_PRICED} SELECT {K}, price, cny, CASE WHEN cny THEN {USD('price')} ELSE price END AS usd FROM judged")
def trade_price_usd(spark, sf_dir):
    """C22, C23"""
    o = offers(spark, sf_dir).withColumn("price", numbers.to_number(F.col("price_text"))).withColumn("cny", price.is_cny(F.col("price"), F.col("price_text")))
    return o.select(*KEY, "price", "cny", F.when(F.col("cny"), price.to_usd(F.col("price"))).otherwise(F.col("price")).alias("usd"))


@query(f"""WITH {OFFERS_SQL}, {_PRICED}, usd AS (SELECT *, CASE WHEN cny THEN {USD('price')} ELSE price END AS u FROM judged)
 SELECT raw_brand, term, count(u) AS n_prices, count(CASE WHEN u >= 1000 AND u < 200000 THEN 1 END) AS n_kept, CAST(sum(CASE WHEN u >= 1000 AND u < 200000 THEN u END) AS BIGINT) AS total FROM usd GROUP BY raw_brand, term""")
def price_bounds(spark, sf_dir):
    """Prices inside the bounds by brand and term"""
    usd = trade_price_usd_rows(offers(spark, sf_dir))
    kept = price.in_bounds(F.col("u"))
    return usd.groupBy("raw_brand", "term").agg(F.count("u").alias("n_prices"), F.count(kept).alias("n_kept"), F.sum(kept).alias("total"))


def trade_price_usd_rows(o: DataFrame) -> DataFrame:
    n = numbers.to_number(F.col("price_text"))
    o = o.withColumn("_p", n).withColumn("_c", price.is_cny(F.col("_p"), F.col("price_text")))
    return o.withColumn("u", F.when(F.col("_c"), price.to_usd(F.col("_p"))).otherwise(F.col("_p"))).drop("_p", "_c")


def _ladder_sql() -> str:
    pairs = [f"CASE WHEN {b.lower()} - {a.lower()} < {base - tol} OR {b.lower()} - {a.lower()} > {base + tol} THEN '外贸价格异常({a}->{b}差价$' || ({b.lower()} - {a.lower()}) || ', 需在${base - tol}~${base + tol}区间)' END" for a, b, base, tol in fixed.PRICE_BANDS]
    return f"concat_ws('; ', {', '.join(pairs)})"


@query(f"WITH {OFFERS_SQL}, t AS (SELECT {K}, 10000 + qty AS exw, CASE WHEN m % 7 = 0 THEN NULL ELSE 10000 + m * 20 END AS fca, 11000 + m * 10 AS fob FROM offers) SELECT {K}, {_ladder_sql()} AS warnings FROM t")
def price_ladder(spark, sf_dir):
    """C33"""
    t = offers(spark, sf_dir).select(*KEY, (F.lit(10000) + F.col("qty")).alias("exw"), F.expr("CASE WHEN m % 7 = 0 THEN NULL ELSE 10000 + m * 20 END").alias("fca"), F.expr("11000 + m * 10").alias("fob"))
    return t.select(*KEY, F.array_join(price.ladder_warnings(F.col("exw"), F.col("fca"), F.col("fob")), "; ").alias("warnings"))


@query(f"""WITH {OFFERS_SQL}, t AS (SELECT {K}, qty, upper(regexp_extract(location_text, '(?i)(FCA|FOB|EXW)', 1)) AS named FROM offers)
 SELECT {K}, CASE WHEN named NOT IN ('FCA', 'FOB') THEN qty END AS exw, CASE WHEN named = 'FCA' THEN qty END AS fca, CASE WHEN named = 'FOB' THEN qty END AS fob FROM t""")
def term_reassign(spark, sf_dir):
    """C25"""
    none = F.lit(None).cast("long")
    moved = price.reassign_term(F.col("qty"), none, none, F.col("location_text"))
    return offers(spark, sf_dir).select(*KEY, moved.alias("t")).select(*KEY, "t.exw", "t.fca", "t.fob")


@query(f"""WITH {OFFERS_SQL}, t AS (SELECT {K}, price_text AS t, TRY_CAST(regexp_extract(price_text, '(?i)EXW[^0-9]{{0,12}}([0-9]{{4,7}})', 1) AS BIGINT) AS v FROM offers)
 SELECT {K}, CASE WHEN v >= 500 AND v < 2000000 THEN CASE WHEN regexp_matches(t, '(?i)EXW[^;\\n\\r]{{0,20}}(人民币|RMB|CNY|¥|￥)') THEN {USD('v')} ELSE v END END AS price,
 CASE WHEN v >= 500 AND v < 2000000 AND regexp_matches(t, '(?i)EXW[^;\\n\\r]{{0,20}}(人民币|RMB|CNY|¥|￥)') THEN v END AS cny FROM t""")
def price_in_text(spark, sf_dir):
    """C28"""
    found = price.price_in_text(F.col("price_text"), "EXW")
    return offers(spark, sf_dir).select(*KEY, found.alias("f")).select(*KEY, "f.price", "f.cny")


@query(f"WITH {OFFERS_SQL}, {_PRICED} SELECT {K}, CASE WHEN NOT (qty * 300 <= 15000 AND coalesce(price = qty * 300, FALSE)) THEN qty * 300 END AS cny, CASE WHEN term = '' AND price < 30000 OR term = 'FOB' THEN price END AS usd FROM judged")
def echo_and_split(spark, sf_dir):
    """C29, C32"""
    o = offers(spark, sf_dir).withColumn("price", numbers.to_number(F.col("price_text")))
    split = price.split_currency(F.col("price"), F.when(F.col("term") == "", "").when(F.col("term") == "FOB", "USD").otherwise("CNY"))
    return o.select(*KEY, price.without_echo(F.col("qty") * 300, F.col("price")).alias("cny"), split["usd"].alias("usd"))


# ---- first-match rules

_BRANDS = values([(i, *r) for i, r in enumerate(fixed.BRAND_NAMES)])


@query(f"""WITH {OFFERS_SQL}, r(prio, zh, en) AS ({_BRANDS}), hit AS (SELECT raw_brand, arg_min(en, prio) AS brand_en FROM (SELECT DISTINCT raw_brand FROM offers) JOIN r ON contains(raw_brand, zh) GROUP BY raw_brand)
 SELECT {K}, o.raw_brand, brand_en FROM offers o LEFT JOIN hit USING (raw_brand)""")
def brand_translate(spark, sf_dir):
    """J2, J12"""
    return matching.translate_brand(offers(spark, sf_dir).select(*KEY, "raw_brand"), "raw_brand", rules.brand_names(spark))


_MODELS = values([(i, *r) for i, r in enumerate(rules.built_in_brand_models())])
_SQ = lambda x: f"lower(replace({x}, ' ', ''))"


@query(f"""WITH {OFFERS_SQL}, r(prio, raw_brand_, raw_model_, brand, model) AS ({_MODELS}), k AS (SELECT DISTINCT raw_brand, raw_model, {_SQ('raw_brand')} AS bt, {_SQ('raw_model')} AS mt FROM offers),
 hit AS (SELECT raw_brand, raw_model, arg_min(brand, prio) AS mapped_brand, arg_min(model, prio) AS mapped_model FROM k JOIN (SELECT *, {_SQ('raw_brand_')} AS rb, {_SQ('brand')} AS mb, {_SQ('raw_model_')} AS rm FROM r) r
   ON (contains(bt, rb) OR contains(bt, mb) OR (rb IN ('比亚迪', 'byd') AND (contains(bt, 'byd') OR contains(bt, '比亚迪'))))
   AND CASE WHEN length(rm) <= 2 THEN rm = mt OR rm = bt ELSE contains(mt, rm) OR contains(bt, rm) OR (contains(rm, 'ev') AND contains(mt, replace(rm, 'ev', ''))) END GROUP BY raw_brand, raw_model)
 SELECT {K}, o.raw_brand, o.raw_model, mapped_brand, mapped_model FROM offers o LEFT JOIN hit USING (raw_brand, raw_model)""")
def model_map(spark, sf_dir):
    """J4 on the offers' brands and models"""
    return identity.map_brand_model(offers(spark, sf_dir).select(*KEY, "raw_brand", "raw_model"), "raw_brand", "raw_model", rules.brand_models(spark))


@query(f"""WITH r(prio, kind, code, name) AS ({values([(i, 'prefix', *r) for i, r in enumerate(fixed.CODE_PREFIXES)] + [(1000 + i, 'equals', *r) for i, r in enumerate(fixed.CODE_EXACT)])}),
 k AS (SELECT DISTINCT 'LZW' || (6380 + p_size * 3) || 'X' AS code_text FROM part), hit AS (SELECT code_text, arg_min(name, prio) AS code_name FROM k JOIN r ON (kind = 'prefix' AND starts_with(code_text, code)) OR (kind = 'equals' AND code_text = code) GROUP BY code_text)
 SELECT p_partkey, 'LZW' || (6380 + p_size * 3) || 'X' AS code_text, code_name FROM part LEFT JOIN hit ON hit.code_text = 'LZW' || (6380 + p_size * 3) || 'X'""")
def code_prefix(spark, sf_dir):
    """J5"""
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("LZW"), (F.lit(6380) + F.col("p_size") * 3).cast("string"), F.lit("X")).alias("code_text"))
    return matching.resolve_code(p, "code_text", rules.code_prefixes(spark))


_PLACE = f"""CASE WHEN clean = '' OR lower(clean) IN ({', '.join("'" + w.lower() + "'" for w in fixed.NOT_LOCATIONS)}) THEN NULL ELSE clean END"""


@query(f"""WITH {OFFERS_SQL}, r(prio, key, canonical) AS ({values([(i, *r) for i, r in enumerate(sorted(fixed.LOCATIONS, key=lambda p: -len(p[0])))])}),
 k AS (SELECT {K}, {_PLACE} AS place_key FROM (SELECT *, trim(regexp_replace(location_text, '(?i)^(FCA|FOB|EXW)\\s*', '')) AS clean FROM offers)),
 hit AS (SELECT place_key, arg_min(canonical, prio) AS c FROM (SELECT DISTINCT place_key FROM k) JOIN r ON contains(place_key, key) GROUP BY place_key)
 SELECT {K}, k.place_key, coalesce(c, k.place_key) AS place FROM k LEFT JOIN hit ON k.place_key = hit.place_key""")
def location_canon(spark, sf_dir):
    """C27 with the rule table"""
    o = offers(spark, sf_dir).select(*KEY, location.place_key(F.col("location_text")).alias("place_key"))
    return matching.canonical_place_join(o, "place_key", rules.places(spark))


@query(f"WITH {OFFERS_SQL} SELECT location_text, count(*) AS n, min(CASE location_text WHEN 'FCA南沙港' THEN '南沙' WHEN '广州南沙' THEN '南沙' WHEN 'FOB上海' THEN '上海' WHEN '霍尔果斯综合保税区' THEN '霍尔果斯' END) AS place FROM offers GROUP BY location_text")
def location_counts(spark, sf_dir):
    """C26, C27 as an expression"""
    place = location.chosen_place([], [F.col("location_text")])
    return offers(spark, sf_dir).groupBy("location_text").agg(F.count("*").alias("n"), F.min(place).alias("place"))


_HEADERS = "concat(CASE CAST(l_orderkey % 8 AS INT) WHEN 0 THEN '官方指导价' WHEN 1 THEN '提货地点' WHEN 2 THEN '外观色' WHEN 3 THEN 'FOB RMB' WHEN 4 THEN '合计' WHEN 5 THEN 'brand' WHEN 6 THEN '序号' ELSE 'x' END, CASE WHEN l_linenumber > 3 THEN ' ' ELSE '' END)"


def _header_rules() -> list[tuple]:
    registry: dict[str, str] = {}
    for _, _, name, _, aliases in fixed.FIELDS:
        registry |= {a.lower(): name for a in aliases}
    named = [("equals", f.lower(), f) for f, _ in fixed.HEADER_ALIASES]
    return [(i, *r) for i, r in enumerate(named + [("contains", a.lower(), f) for f, al in fixed.HEADER_ALIASES for a in al] + [("contains", a, f) for a, f in registry.items()])]


@query(f"""WITH r(prio, kind, pattern, field) AS ({values(_header_rules())}), k AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_HEADERS} AS header FROM lineitem),
 c AS (SELECT DISTINCT header, CASE WHEN h = '' OR h IN ({', '.join("'" + w + "'" for w in fixed.HEADER_IGNORED)}) OR regexp_matches(h, '{'|'.join(fixed.SUMMARY_WORDS)}') THEN NULL ELSE h END AS h FROM (SELECT header, lower(trim(header)) AS h FROM k)),
 hit AS (SELECT header, arg_min(field, prio) AS field FROM c JOIN r ON (kind = 'equals' AND h = pattern) OR (kind = 'contains' AND contains(h, pattern)) GROUP BY header)
 SELECT {K}, k.header, field FROM k LEFT JOIN hit ON k.header = hit.header""")
def header_map(spark, sf_dir):
    """B1"""
    h = table(spark, sf_dir, "lineitem").select(*KEY, F.expr(_HEADERS).alias("header"))
    return matching.map_headers(h, "header", rules.header_rules(spark))


@query(f"""WITH {OFFERS_SQL}, v(brand) AS ({values([(b,) for b in fixed.VALID_BRANDS])}), r(prio, zh, en) AS ({_BRANDS}),
 hit AS (SELECT raw_brand, arg_min(en, prio) AS brand_en FROM (SELECT DISTINCT raw_brand FROM offers) JOIN r ON contains(raw_brand, zh) GROUP BY raw_brand)
 SELECT brand_en, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM offers JOIN hit USING (raw_brand) WHERE brand_en IN (SELECT brand FROM v) GROUP BY brand_en""")
def valid_brand_semi(spark, sf_dir):
    """J8"""
    o = matching.translate_brand(offers(spark, sf_dir).select("raw_brand", "qty"), "raw_brand", rules.brand_names(spark))
    return matching.with_valid_brand(o, "brand_en", rules.valid_brands(spark)).groupBy("brand_en").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


_CK = lambda x: f"lower(regexp_replace({x}, '[\\s_\\-/：:]+', '', 'g'))"


@query(f"""SELECT {_CK('p_brand')} AS brand_key, list_sort(list_distinct(list({_CK('m')}))) AS keys FROM (SELECT p_brand, unnest([p_type, p_name]) AS m FROM part) WHERE length(trim(m)) >= 2 GROUP BY 1""")
def family_sets(spark, sf_dir):
    """E4 with brands and names of parts as the map"""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("raw_brand"), F.col("p_brand").alias("brand"), F.col("p_type").alias("raw_model"), F.col("p_name").alias("model"))
    return matching.family_keys(p)


@query(f"""WITH {OFFERS_SQL}, t AS (SELECT qty, CASE raw_brand WHEN '比亚迪' THEN 'BYD' WHEN 'BYD' THEN 'BYD' WHEN '吉利' THEN 'Geely' WHEN '极氪' THEN 'Zeekr' WHEN '小米' THEN 'Xiaomi' WHEN '方程豹' THEN 'Fangchengbao' WHEN '五菱' THEN 'Wuling'
   WHEN '零跑' THEN 'Leapmotor' WHEN '广汽埃安' THEN 'GAC' WHEN '问界' THEN 'AITO' WHEN '未知' THEN CASE WHEN contains(location_text, '小马奔腾') THEN 'Leapmotor' END END AS brand,
  CASE raw_model WHEN '海豚' THEN 'Dolphin' WHEN '银河 E5' THEN 'Galaxy E5' WHEN '豹5' THEN 'Leopard 5' WHEN 'LZW6470X' THEN 'Starlight S' WHEN '' THEN CASE WHEN contains(location_text, '小马奔腾') THEN 'T03' END ELSE raw_model END AS model FROM offers)
 SELECT brand, model, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM t WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY brand, model""")
def identity_resolved(spark, sf_dir):
    """J2-J7, V1, V2, C40 on the offers: listings by resolved brand and model"""
    o = offers(spark, sf_dir).select("raw_brand", "raw_model", "qty", F.concat_ws(" ", "raw_brand", "raw_model", "location_text").alias("free"))
    o = identity.resolve_identity(o, "raw_brand", "raw_model", rules.brand_names(spark), rules.brand_models(spark), rules.code_prefixes(spark))
    o = identity.identity_from_text(o, "resolved_brand", "resolved_model", "free", rules.brand_models(spark))
    o = identity.resolved_only(o, "resolved_brand", "resolved_model").withColumn("brand", identity.override_brand(F.col("resolved_brand"), F.col("free")))
    return o.groupBy("brand", F.col("resolved_model").alias("model")).agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


# ---- colours and variants


@query(f"""WITH {OFFERS_SQL} SELECT {K}, CASE colour_text WHEN '110白' THEN '白' WHEN '白/黑' THEN '白' WHEN '/' THEN NULL ELSE colour_text END AS exterior,
 CASE colour_text WHEN '白/黑' THEN '黑' END AS interior, CASE WHEN regexp_matches(colour_text, '^\\d+\\s*[\\x{{4e00}}-\\x{{9fa5}}A-Za-z/]+$') THEN CAST(regexp_extract(colour_text, '^(\\d+)', 1) AS BIGINT) END AS quantity FROM offers""")
def colour_parse(spark, sf_dir):
    """C11"""
    return offers(spark, sf_dir).select(*KEY, color.parse_colour(F.col("colour_text")).alias("c")).select(*KEY, "c.exterior", "c.interior", "c.quantity")


_PART = r"^(\d+)\s*([\x{4e00}-\x{9fa5}A-Za-z]+)(?:/([\x{4e00}-\x{9fa5}A-Za-z]+))?$"


@query(f"""WITH {OFFERS_SQL}, o AS (SELECT {K}, qty, CASE colour_text WHEN '110白' THEN '白' WHEN '白/黑' THEN '白' WHEN '/' THEN NULL ELSE colour_text END AS e, CASE colour_text WHEN '白/黑' THEN '黑' END AS i FROM offers),
 s AS (SELECT *, CASE WHEN regexp_matches(e, '[+;；、]') THEN string_split_regex(e, '[+；;、]') ELSE [e] END AS parts, coalesce(regexp_matches(e, '[+;；、]'), FALSE) AS many FROM o),
 x AS (SELECT * EXCLUDE (parts), unnest(parts) AS p, generate_subscripts(parts, 1) - 1 AS split_no FROM s)
 SELECT {K}, CAST(split_no AS INT) AS split_no, CASE WHEN many AND regexp_matches(p, '{_PART}') THEN CAST(regexp_extract(p, '{_PART}', 1) AS BIGINT) ELSE qty END AS stock_quantity,
 CASE WHEN many AND regexp_matches(p, '{_PART}') THEN regexp_extract(p, '{_PART}', 2) ELSE p END AS exterior_color, CASE WHEN many AND regexp_matches(p, '{_PART}') THEN nullif(regexp_extract(p, '{_PART}', 3), '') ELSE i END AS interior_color FROM x""")
def colour_explode(spark, sf_dir):
    """F3"""
    o = offers(spark, sf_dir).select(*KEY, F.col("qty").alias("stock_quantity"), color.parse_colour(F.col("colour_text")).alias("c"))
    o = o.select(*KEY, "stock_quantity", F.col("c.exterior").alias("exterior_color"), F.col("c.interior").alias("interior_color"))
    return candidates.explode_colours(o).select(*KEY, "split_no", "stock_quantity", "exterior_color", "interior_color")


@query("""WITH t AS (SELECT p_partkey, p_name || ' 豪华版 | 220000 | 宁德' || p_size || 'kWh' AS v, p_name, p_size FROM part)
 SELECT p_partkey, p_name || ' 豪华版' AS kept, '220000; 宁德' || p_size || 'kWh' AS details FROM t""")
def variant_segments(spark, sf_dir):
    """C12"""
    p = table(spark, sf_dir, "part").select("p_partkey", variant.noise_segments(F.format_string("%s 豪华版 | 220000 | 宁德%dkWh", "p_name", "p_size")).alias("s"))
    return p.select("p_partkey", F.col("s.text").alias("kept"), F.array_join("s.details", "; ").alias("details"))


@query(f"""WITH {OFFERS_SQL}, t AS (SELECT {K}, m, raw_model, CASE WHEN m % 3 = 0 THEN '57,800' WHEN m % 3 = 1 THEN '豪华版' END AS v FROM offers)
 SELECT {K}, CASE WHEN m % 3 = 1 THEN '豪华版' END AS variant, CASE WHEN m % 3 = 0 THEN 57800 END::BIGINT AS price FROM t""")
def variant_number(spark, sf_dir):
    """C20"""
    o = offers(spark, sf_dir).withColumn("v", F.expr("CASE WHEN m % 3 = 0 THEN '57,800' WHEN m % 3 = 1 THEN '豪华版' END"))
    return o.select(*KEY, variant.numeric_variant(F.col("v"), F.lit(None).cast("long")).alias("n")).select(*KEY, "n.variant", "n.price")


# ---- dedup, ids, batches


@query("""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source, lang, text ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def dedup_first(spark, sf_dir):
    """F1 on documents: the first of each source, language and text"""
    d = table(spark, sf_dir, "documents").withColumn("t", F.sha2("text", 256)).drop("text")
    return candidates.keep_first(d, [F.col("source"), F.col("lang"), F.col("t")], ["doc_id"]).select("doc_id", "source")


@query(f"""WITH {OFFERS_SQL}, {_PRICED}, f AS (SELECT {K}, supplier, raw_brand, raw_model, CASE WHEN colour_text = '/' THEN NULL ELSE colour_text END AS e, price FROM judged),
 once AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY supplier, raw_brand, raw_model, coalesce(e, ''), price ORDER BY {K}) = 1)
 SELECT {K} FROM once QUALIFY NOT (price IS NULL AND e IS NULL) OR row_number() OVER (PARTITION BY price IS NULL AND e IS NULL, supplier, raw_brand, raw_model ORDER BY {K}) = 1""")
def priceless_collapse(spark, sf_dir):
    """F1, F2 on offers"""
    none = F.lit(None)
    o = offers(spark, sf_dir).select(
        *KEY, "supplier", F.col("raw_brand").alias("brand"), F.col("raw_model").alias("model"), none.cast("string").alias("variant"), F.when(F.col("colour_text") != "/", F.col("colour_text")).alias("exterior_color"),
        none.cast("string").alias("interior_color"), none.cast("long").alias("stock_quantity"), none.cast("long").alias("supplier_price_cny"), numbers.to_number(F.col("price_text")).alias("cost_exw_usd"),
        none.cast("long").alias("cost_fob_usd"), none.cast("long").alias("cost_fca_usd"), *[none.cast("string").alias(c) for c in ("location", "version_type", "steering_setup", "source_file")],
    )
    return candidates.dedup_candidates(o, list(KEY)).select(*KEY)


@query("""WITH f AS (SELECT p_brand, p_type, min(p_partkey) AS k FROM part GROUP BY ALL), n AS (SELECT *, row_number() OVER (ORDER BY k, p_brand, p_type) + 64 AS i FROM f)
 SELECT p_brand, p_type, 'MDL-' || lpad(i::VARCHAR, greatest(length(i::VARCHAR), 3)::INT, '0') AS id FROM n""")
def model_ids(spark, sf_dir):
    """F4"""
    return identity.numbered_ids(table(spark, sf_dir, "part"), ["p_brand", "p_type"], "p_partkey")


@query("""WITH f AS (SELECT p_brand, p_type, min(p_partkey) AS k FROM part GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY k, p_type)::VARCHAR AS i FROM f)
 SELECT p_brand, p_type, p_brand || '-V' || lpad(i, greatest(length(i), 2)::INT, '0') AS id FROM n""")
def variant_ids(spark, sf_dir):
    """F5"""
    return identity.numbered_variants(table(spark, sf_dir, "part"), "p_brand", "p_type", "p_partkey")


@query("""WITH d AS (SELECT DISTINCT lower(s_name) AS brand, CAST(s_nationkey AS VARCHAR) AS model, 'ID-' || s_suppkey AS id FROM supplier),
 loose AS (SELECT model, max_by(id, CAST(substr(id, 4) AS BIGINT)) AS id FROM d GROUP BY model)
 SELECT c_custkey, coalesce(e.id, l.id) AS model_id FROM customer LEFT JOIN d e ON lower(replace(c_name, 'Customer', 'Supplier')) = e.brand AND CAST(c_nationkey AS VARCHAR) = e.model LEFT JOIN loose l ON CAST(c_nationkey AS VARCHAR) = l.model""")
def dimension_lookup(spark, sf_dir):
    """Suppliers as dimension of (name, nation), looked up by customers with the nation alone as fallback"""
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("brand"), F.col("s_nationkey").cast("string").alias("model"), F.concat(F.lit("ID-"), F.col("s_suppkey").cast("string")).alias("model_id"), F.col("s_suppkey").alias("ord"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("b"), F.col("c_nationkey").cast("string").alias("m"))
    return matching.lookup_with_fallback(c, records.dimension_index(s), "b", "m").select("c_custkey", "model_id")


# ---- states


@query(f"""WITH {OFFERS_SQL} SELECT {K}, CAST({_WAIT} AS BIGINT) AS days, CASE WHEN wait_text = '现车' THEN '现车' WHEN wait_text = '' THEN '无具体信息' ELSE '在途' END AS status,
 CASE WHEN term = 'FOB' THEN '国际版' ELSE '国内版' END AS version, CASE WHEN term = 'FCA' THEN '右舵' ELSE '左舵' END AS steering FROM offers""")
def availability(spark, sf_dir):
    """C6, C7, C8"""
    scope = F.expr("CASE term WHEN 'FOB' THEN '出口' WHEN 'FCA' THEN 'rhd' ELSE '' END")
    o = offers(spark, sf_dir).withColumn("a", state.availability(F.col("wait_text"), F.lit(None).cast("string")))
    return o.select(*KEY, "a.days", "a.status", state.version_type(scope).alias("version"), state.steering(scope).alias("steering"))


@query(f"""WITH {OFFERS_SQL} SELECT {K}, (100 - CASE WHEN raw_brand = '未知' THEN 15 ELSE 0 END - CASE WHEN raw_model = '' THEN 15 ELSE 0 END - CASE WHEN term = '' THEN 25 ELSE 0 END
 - CASE WHEN location_text = '' THEN 6 ELSE 0 END - CASE WHEN price_text = '面议' THEN 25 ELSE 0 END) / 100.0::DOUBLE AS confidence FROM offers""")
def confidence_score(spark, sf_dir):
    """C34"""
    score = state.confidence(F.lit(None).cast("string"), F.col("supplier"), F.col("raw_brand"), F.col("raw_model"), F.col("term"), F.col("location_text"), numbers.to_number(F.col("price_text")).isNotNull(), F.lit("左舵"), F.lit("国内版"))
    return offers(spark, sf_dir).select(*KEY, score.alias("confidence"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus' ELSE '' END || CASE WHEN o_orderstatus NOT IN ('F', 'O') AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN ',' ELSE '' END
 || CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'o_orderpriority' ELSE '' END AS violations FROM orders""")
def enum_check(spark, sf_dir):
    """V3"""
    o = validation.enum_violations(table(spark, sf_dir, "orders"), {"o_orderstatus": ("F", "O"), "o_orderpriority": ("1-URGENT", "2-HIGH")})
    return o.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (event_type IN ('pass', 'purchase') AND contains('已通过' || event_type, '通过') OR contains('已通过' || event_type, '通过')) AS approved FROM events GROUP BY event_type")
def approved(spark, sf_dir):
    """C35, E6"""
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(state.is_approved(F.array(F.concat(F.lit("已通过"), "event_type")))).alias("approved"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) / 100 AS confidence, CAST(json_extract(props, '$.k') AS DOUBLE) / 100 < 0.6 AS review FROM events")
def json_confidence(spark, sf_dir):
    """The events' property as a score at some depth of a response"""
    k = F.get_json_object("props", "$.k").cast("double") / 100
    response = F.concat(F.lit('{"a":[{"confidence":'), k.cast("string"), F.lit('},{"b":{"x":1}}]}'))
    e = table(spark, sf_dir, "events").select("event_id", state.json_confidence(response).alias("confidence"))
    return e.select("event_id", "confidence", state.needs_review(F.col("confidence")).alias("review"))


# ---- grids

_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value, generate_subscripts(string_split(text, chr(10)), 1) AS row_no FROM documents)"


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as rows of sheets, words as cells."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("source").alias("sheet"), F.posexplode(F.split("text", "\n")).alias("r", "line"))
    return d.select("path", "sheet", (F.col("r") + 1).alias("row_no"), F.posexplode(F.split("line", " ")).alias("c", "value")).select("path", "sheet", "row_no", (F.col("c") + 1).alias("col_no"), "value")


@query("""WITH c AS (SELECT doc_id, row_no, unnest(string_split(value, ' ')) AS v, generate_subscripts(string_split(value, ' '), 1) AS col_no FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS value, generate_subscripts(string_split(text, chr(10)), 1) AS row_no FROM documents)),
 top AS (SELECT doc_id, v FROM c WHERE row_no = 1 AND col_no = 1)
 SELECT c.doc_id AS path, count(*) FILTER (c.row_no <= 2 AND c.col_no <= 3 AND c.v = top.v) AS same, count(*) AS n FROM c JOIN top USING (doc_id) GROUP BY c.doc_id""")
def merged_base(spark, sf_dir):
    """Counts that merged_fill raises: cells of the top left block that equal its first cell"""
    c = document_cells(spark, sf_dir)
    first = Window.partitionBy("path")
    c = c.withColumn("top", F.max(F.when((F.col("row_no") == 1) & (F.col("col_no") == 1), F.col("value"))).over(first))
    return c.groupBy("path").agg(F.count_if((F.col("row_no") <= 2) & (F.col("col_no") <= 3) & (F.col("value") == F.col("top"))).alias("same"), F.count("*").alias("n"))


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events""")
def text_carry_forward(spark, sf_dir):
    """F6 on events: the last purchase up to each event of a user"""
    e = table(spark, sf_dir, "events")
    last = grid.carry_forward(F.when(F.col("event_type") == "purchase", F.col("value")), ["ts", "event_id"], ["user_id"])
    return e.select("event_id", "user_id", last.alias("last_purchase"))


@query("""SELECT '/input/S/L/B/M/' || c_custkey || '.csv' AS path, c_name AS model, '比亚迪' AS brand, c_mktsegment AS exterior, '电池: ' || c_nationkey || '; 续航: ' || c_custkey AS notes, 'S' AS supplier FROM customer""")
def vertical_pivot(spark, sf_dir):
    """Customers as key/value sheets"""
    c = table(spark, sf_dir, "customer")
    pairs = [("项目名称", F.col("c_name")), ("品牌", F.lit("比亚迪")), ("颜色", F.col("c_mktsegment")), ("电池", F.col("c_nationkey").cast("string")), ("续航", F.col("c_custkey").cast("string"))]
    path = F.concat(F.lit("/input/S/L/B/M/"), F.col("c_custkey").cast("string"), F.lit(".csv"))
    rows = c.select(path.alias("path"), F.lit("Sheet1").alias("sheet"), F.posexplode(F.array(*[F.array(F.lit(k), v) for k, v in pairs])).alias("r", "cells"))
    cells = rows.select("path", "sheet", (F.col("r") + 1).alias("row_no"), F.posexplode("cells").alias("c", "value")).select("path", "sheet", "row_no", (F.col("c") + 1).alias("col_no"), "value")
    cells = written(cells, "vertical")
    out = grid.pivot_vertical(cells.join(grid.vertical_sheets(cells), grid.SHEET, "left_semi"), rules.header_rules(spark))
    return out.select("path", "model", "brand", F.col("exteriorColor").alias("exterior"), "notes", "supplier")


@query(f"""WITH {OFFERS_SQL}, t AS (SELECT '/input/' || supplier || '/L/B/T03/f.txt' AS path, row_number() OVER (PARTITION BY supplier ORDER BY {K}) AS row_no, price_text AS t FROM offers),
 p AS (SELECT path, row_no, coalesce(TRY_CAST(regexp_extract(t, '[$]\\s*(\\d{{4,6}})', 1) AS BIGINT), TRY_CAST(regexp_extract(t, 'EXW\\s*(\\d{{4,6}})', 1) AS BIGINT)) AS n FROM t)
 SELECT path, CAST(row_no AS INT) AS row_no, CAST(n AS VARCHAR) AS price, 'T03' AS model FROM p WHERE n > 0""")
def text_listings(spark, sf_dir):
    """The offers' price texts as running text below a model folder"""
    o = offers(spark, sf_dir).withColumn("row_no", F.row_number().over(Window.partitionBy("supplier").orderBy(*KEY)))
    t = o.select(F.concat(F.lit("/input/"), "supplier", F.lit("/L/B/T03/f.txt")).alias("path"), F.lit("s").alias("sheet"), "row_no", F.col("price_text").alias("text"))
    return grid.text_rows(t).select("path", "row_no", F.col("priceExw").alias("price"), "model")


@query(f"WITH {OFFERS_SQL} SELECT supplier, raw_brand AS brand, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM offers GROUP BY supplier, raw_brand")
def header_detect(spark, sf_dir):
    """B2-B9 on made-up sheets of the offers: a header row and one row per listing, back to fields"""
    o = offers(spark, sf_dir)
    names = ("品牌", "车型", "EXW", "数量", "提货地")
    body = o.select(F.concat(F.lit("/input/"), "supplier", F.lit("/南沙/b/m/f.csv")).alias("path"), F.lit("Sheet1").alias("sheet"), F.struct(*KEY).alias("k"), F.array("raw_brand", "raw_model", (F.lit(10000) + F.col("qty")).cast("string"), F.col("qty").cast("string"), "location_text").alias("cells"))
    body = body.withColumn("row_no", F.row_number().over(Window.partitionBy("path").orderBy("k")) + 1).select("path", "sheet", "row_no", "cells")
    head = body.select("path", "sheet").distinct().select("path", "sheet", F.lit(1).alias("row_no"), F.array(*map(F.lit, names)).alias("cells"))
    cells = written(head.unionByName(body).select("path", "sheet", "row_no", F.posexplode("cells").alias("c", "value")).select("path", "sheet", "row_no", (F.col("c") + 1).alias("col_no"), "value"), "cells")
    rows = grid.pivot_rows(cells, written(grid.header_map(cells, rules.header_rules(spark)), "headers"))
    return rows.groupBy("supplier", "brand").agg(F.count("*").alias("n"), F.sum(numbers.to_number(F.col("stockQuantity"))).alias("qty"))


@query(f"""WITH {OFFERS_SQL} SELECT supplier, raw_brand AS brand, coalesce(nullif(raw_model, ''), 'x.xlsx') AS model, '南沙' AS location, count(*) AS n FROM offers GROUP BY ALL""")
def path_meta(spark, sf_dir):
    """Folders of offers; without a model folder the file name takes its place"""
    p = offers(spark, sf_dir).select(F.concat_ws("/", F.lit("/data/input"), "supplier", F.lit("FCA 南沙"), "raw_brand", "raw_model", F.lit("x.xlsx")).alias("p"))
    m = p.select(location.path_metadata(F.col("p")).alias("m")).select("m.*")
    return m.groupBy("supplier", "brand", "model", "location").agg(F.count("*").alias("n"))


_KNOWN = ", ".join("'" + w.lower() + "'" for w in (*fixed.PATH_BRANDS, *fixed.PATH_MODELS))


@query(f"""WITH t AS (SELECT page_id, s, regexp_replace(s, '(?i)^(FCA|FOB|EXW)\\s*', '') AS c FROM (SELECT page_id, unnest(string_split(url, '/')) AS s FROM pages))
 SELECT page_id, s, CASE WHEN s <> '' AND c NOT IN ({', '.join("'" + w + "'" for w in fixed.UNKNOWN_PLACES)}) AND lower(c) NOT IN ({_KNOWN}) AND (regexp_matches(s, '(?i)^(FCA|FOB|EXW)') OR regexp_matches(c, '{'|'.join(fixed.PATH_LOCATIONS)}')
 OR regexp_matches(c, '(港|仓|基地|保税区|关|口岸)$') OR (length(c) >= 2 AND NOT regexp_matches(c, '表|车源|价格|配置|xlsx|csv|doc'))) THEN c END AS place FROM t""")
def physical_places(spark, sf_dir):
    """A8 over path segments of pages"""
    p = table(spark, sf_dir, "pages").select("page_id", F.explode(F.split("url", "/")).alias("s"))
    return p.select("page_id", "s", location.physical_place(F.col("s")).alias("place"))


# ---- staging and changes


@query("SELECT c_custkey FROM customer WHERE md5(CAST(c_nationkey AS VARCHAR) || c_mktsegment) NOT IN (SELECT md5(CAST(s_nationkey AS VARCHAR) || 'BUILDING') FROM supplier)")
def anti_ledger(spark, sf_dir):
    """J1"""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.md5(F.concat(F.col("c_nationkey").cast("string"), "c_mktsegment")).alias("content_hash"))
    s = table(spark, sf_dir, "supplier").select(F.md5(F.concat(F.col("s_nationkey").cast("string"), F.lit("BUILDING"))).alias("content_hash"))
    from ..sources.files import unseen

    return unseen(c, s).select("c_custkey")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'edited' ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer""")
def apply_edits(spark, sf_dir):
    """Edits of customers"""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_nationkey")
    e = c.where("id % 3 = 0").select("id", F.lit("c_name").alias("key"), F.lit("edited").alias("value"))
    e = e.unionByName(c.where("id % 5 = 0").select("id", F.lit("c_mktsegment").alias("key"), F.lit(None).cast("string").alias("value"))).unionByName(c.where("id % 7 = 0").select("id", F.lit("nope").alias("key"), F.lit("x").alias("value")))
    good, _ = staging.split_edits(e, ("c_name", "c_mktsegment", "c_nationkey"))
    return staging.apply_edits(c, good)


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'synced' ELSE 'pending' END AS status FROM orders WHERE o_orderkey % 10 <> 0")
def status_transition(spark, sf_dir):
    """G3, G4"""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("pending").alias("status"))
    o = staging.delete_rows(o, o.where("id % 10 = 0"))
    return staging.transition(o, o.where("id % 4 = 0").select("id"))


_NEW_SEGMENT = "CASE WHEN c_custkey % 4 = 0 THEN 'NEW' ELSE c_mktsegment END"


@query(f"""WITH n AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name END AS name2, c_mktsegment, {_NEW_SEGMENT} AS seg2 FROM customer)
 SELECT c_custkey, 'c_name' AS field, c_name AS old_value, nullif(trim(name2), '') AS new_value FROM n WHERE c_name IS DISTINCT FROM nullif(trim(name2), '')
 UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, seg2 FROM n WHERE c_mktsegment IS DISTINCT FROM seg2""")
def snapshot_diff(spark, sf_dir):
    """G6, J11, C42"""
    c = table(spark, sf_dir, "customer")
    now = c.withColumn("c_name", F.expr("CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name END")).withColumn("c_mktsegment", F.expr(_NEW_SEGMENT))
    return changes.field_changes(c, now, "c_custkey", ["c_name", "c_mktsegment"])


@query(f"""WITH n AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name END AS name2, c_mktsegment, {_NEW_SEGMENT} AS seg2 FROM customer),
 d AS (SELECT c_custkey, nullif(name2, '') AS v FROM n WHERE c_name IS DISTINCT FROM nullif(name2, '') UNION ALL SELECT c_custkey, seg2 FROM n WHERE c_mktsegment IS DISTINCT FROM seg2)
 SELECT c_custkey, count(*) AS n_changes, count(v) AS n_distilled FROM d GROUP BY c_custkey""")
def change_counts(spark, sf_dir):
    """E5, G6 on approved records"""
    c = table(spark, sf_dir, "customer")
    now = c.withColumn("c_name", F.expr("CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name END")).withColumn("c_mktsegment", F.expr(_NEW_SEGMENT))
    feed = changes.harvest(c, now, F.lit(True), "c_custkey", ("c_name", "c_mktsegment"))
    return changes.changes_by_record(feed, "c_custkey").select("c_custkey", "n_changes", "n_distilled")


@query("""SELECT 'field_override' AS type, event_type AS field, CAST(user_id AS VARCHAR) AS raw_pattern, arg_max(CAST(value AS DECIMAL(18, 4)), event_id) AS target, min(event_id) AS ord FROM events GROUP BY event_type, user_id""")
def rule_upsert(spark, sf_dir):
    """Events as edits"""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("field"), F.col("user_id").cast("string").alias("old_value"), F.col("value").cast("string").alias("new_value"), F.lit(None).cast("string").alias("context"), F.col("event_id").alias("ord"))
    r = changes.distil(e)
    r = changes.upsert_rules(r.where("ord % 2 = 0"), r.where("ord % 2 = 1"))
    return r.select("type", "field", "raw_pattern", F.col("target_value").cast("decimal(18,4)").alias("target"), "ord")


@query("""SELECT * FROM (SELECT o_custkey AS source, count(*) AS row_count FROM orders GROUP BY ROLLUP (o_custkey))""")
def manifest_rollup(spark, sf_dir):
    """E1"""
    return grid.manifest(table(spark, sf_dir, "orders"), "o_custkey")


@query("""WITH r AS (SELECT user_id, count(*) FILTER (event_type <> 'purchase') AS d, count(*) FILTER (event_type = 'purchase') AS a FROM events GROUP BY user_id)
 SELECT count(*) AS total_runs, sum(d)::BIGINT AS deterministic_hits, sum(a)::BIGINT AS ai_fallbacks, (sum(d) + sum(a))::BIGINT AS total, round(sum(d)::DOUBLE / (sum(d) + sum(a))::DOUBLE * 100.0, 1) AS deterministic_pct, round(sum(a)::DOUBLE / (sum(d) + sum(a))::DOUBLE * 100.0, 1) AS ai_pct FROM r""")
def telemetry(spark, sf_dir):
    """Each user's events as a run"""
    e = table(spark, sf_dir, "events")
    runs = e.groupBy("user_id").agg(F.count_if(F.col("event_type") != "purchase").alias("deterministic"), F.count_if(F.col("event_type") == "purchase").alias("ai"))
    return changes.telemetry(runs)


@query("SELECT c_nationkey AS record_id, arg_max(c_name, c_custkey) AS c_name, arg_max(c_mktsegment, c_custkey) AS c_mktsegment FROM customer GROUP BY c_nationkey")
def snapshot_build(spark, sf_dir):
    """E8"""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("record_id"), F.col("c_custkey").alias("ord"), "c_name", "c_mktsegment")
    return changes.build_snapshot(c)


@query(f"""WITH {OFFERS_SQL} SELECT {K}, supplier AS s, nullif(raw_model, '') AS m FROM offers""")
def sink_payload(spark, sf_dir):
    """Payloads of offers, read back"""
    o = offers(spark, sf_dir).select(F.struct(*KEY).alias("id"), "supplier", F.col("raw_model").alias("model"))
    p = records.sink_payload(o)
    return p.select("id.*", F.get_json_object("record", "$.供应商").alias("s"), F.get_json_object("record", "$.型号").alias("m"))


@query("SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id")
def record_flatten(spark, sf_dir):
    """Events as records with wrapped values, unwrapped and hoisted"""
    wrapped = F.to_json(F.map_from_arrays(F.array(F.lit("user"), F.lit("kind")), F.array(F.col("user_id").cast("string"), F.concat(F.lit('[{"text":"'), "event_type", F.lit('"}]')))))
    e = records.flatten_records(table(spark, sf_dir, "events").select(F.col("event_id").alias("record_id"), wrapped.alias("fields_json")))
    for m in records.META[1:]:
        e = e.withColumn(m, F.lit(None).cast("string"))
    rows = records.hoist_metadata(e)
    return rows.groupBy(F.element_at("row", "user").cast("long").alias("user_id")).agg(F.count("*").alias("n"), F.count_distinct(F.element_at("row", "kind")).alias("kinds"))


_VALID_TURN = "turn % 3 = 2"


@query(f"""WITH v AS (SELECT conv_id, min(turn + 1) AS attempt FROM conversations WHERE {_VALID_TURN} AND turn + 1 <= 3 GROUP BY conv_id)
 SELECT conv_id AS doc_id, CAST(attempt AS INT) AS attempt, attempt IS NULL AS needs_human_review FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN v USING (conv_id)""")
def first_valid_attempt(spark, sf_dir):
    """V4, V5: turns of conversations as attempts; every third is valid"""
    good, bad = r'{"candidates":[{"content":{"parts":[{"text":"{\"candidates\":[{\"brand\":\"BYD\",\"stockQuantity\":1}]}"}]}}]}', r'{"candidates":[{"content":{"parts":[{"text":"{\"candidates\":[{\"stockQuantity\":{\"n\":1}}]}"}]}}]}'
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("attempt"), F.when(F.expr(_VALID_TURN), F.lit(good)).otherwise(F.lit(bad)).alias("response"))
    return validation.first_valid(validation.check_responses(c)).select("doc_id", "attempt", "needs_human_review")


def candidates_full(spark, sf_dir):
    """The whole normalisation over all offers: every candidate"""
    o = offers(spark, sf_dir).select(
        *KEY, "supplier", F.col("raw_brand").alias("brand"), F.col("raw_model").alias("modelName"), F.col("price_text").alias("priceExw"), F.col("location_text").alias("location"), F.col("colour_text").alias("exteriorColor"),
        F.col("wait_text").alias("orderWaitDays"), F.col("qty").cast("string").alias("stockQuantity"),
    )
    out = candidates.format_candidates(o, rules.brand_names(spark), rules.brand_models(spark), rules.code_prefixes(spark), rules.valid_brands(spark), order=KEY)
    given = ("supplier", "brand", "model", "model_id", "status_vehicle", "location", "supplier_price_cny", "cost_exw_usd", "cost_fca_usd", "cost_fob_usd", "stock_quantity", "exterior_color", "interior_color")
    return out.select(*KEY, "split_no", *given)


# ---- streams


def _as_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.readStream.schema(table(spark, sf_dir, name).schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")


def _drained(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there and return the rows it wrote."""
    base = written(spark.range(1), label).inputFiles()[0].rsplit("/", 1)[0]
    out, checkpoint = f"{base}-out", f"{base}-checkpoint"
    jobs.run_available(stream, checkpoint, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}")).awaitTermination()
    return spark.read.schema(stream.schema).option("basePath", out).parquet(f"{out}/batch=*").select(*stream.columns)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Events as a stream, each content once"""
    e = _as_stream(spark, sf_dir, "events").select("user_id", "event_type", "ts").withColumn("content_hash", F.sha2(F.concat_ws("|", "user_id", "event_type"), 256))
    return _drained(spark, jobs.once_by_content(e, at="ts"), "dedup").select("user_id", "event_type")


@query("""SELECT c_custkey, 'c_mktsegment' AS field, c_mktsegment AS old_value, 'NEW' AS new_value FROM customer WHERE c_custkey % 4 = 0""")
def stream_change_feed(spark, sf_dir):
    """A stream of current records against the baseline"""
    base = table(spark, sf_dir, "customer")
    now = _as_stream(spark, sf_dir, "customer").withColumn("c_mktsegment", F.expr(_NEW_SEGMENT))
    mark = written(spark.range(1), "feed").inputFiles()[0].rsplit("/", 1)[0]
    feed = jobs.change_feed(base, "c_custkey", ["c_name", "c_mktsegment"], f"{mark}-out")
    jobs.run_available(now, f"{mark}-checkpoint", feed).awaitTermination()
    return spark.read.option("basePath", f"{mark}-out").parquet(f"{mark}-out/batch=*").select("c_custkey", "field", "old_value", "new_value")


@query(f"""WITH {OFFERS_SQL}, {_PRICED}, usd AS (SELECT *, CASE WHEN cny THEN {USD('price')} ELSE price END AS u FROM judged),
 once AS (SELECT * FROM usd QUALIFY row_number() OVER (PARTITION BY supplier, raw_brand, raw_model, u ORDER BY {K}) = 1)
 SELECT raw_brand, count(*) AS n_offers, count(CASE WHEN u >= 1000 AND u < 200000 THEN 1 END) AS n_priced, CAST(sum(CASE WHEN u >= 1000 AND u < 200000 THEN u END) AS BIGINT) AS total_usd FROM once GROUP BY raw_brand""")
def offers_min(spark, sf_dir):
    """Distinct priced offers by brand"""
    o = trade_price_usd_rows(offers(spark, sf_dir))
    once = candidates.keep_first(o, [F.col(c) for c in ("supplier", "raw_brand", "raw_model", "u")], list(KEY))
    kept = price.in_bounds(F.col("u"))
    return once.groupBy("raw_brand").agg(F.count("*").alias("n_offers"), F.count(kept).alias("n_priced"), F.sum(kept).alias("total_usd"))
