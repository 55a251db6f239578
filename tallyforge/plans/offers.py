"""A listing-shaped view of the star schema, in SQL that Spark and DuckDB read alike."""

OFFERS = """
WITH b AS (
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, p_name,
        CAST(floor(l_extendedprice) AS BIGINT) AS amt, CAST(l_quantity AS BIGINT) AS qty,
        (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 60 AS m, l_partkey % 12 AS mb
 FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name AS supplier,
 CASE mb WHEN 0 THEN '比亚迪' WHEN 1 THEN 'BYD' WHEN 2 THEN '吉利' WHEN 3 THEN '极氪' WHEN 4 THEN '小米' WHEN 5 THEN '方程豹'
         WHEN 6 THEN '五菱' WHEN 7 THEN '零跑' WHEN 8 THEN '广汽埃安' WHEN 9 THEN '未知' ELSE '问界' END AS raw_brand,
 CASE mb WHEN 0 THEN '海豚' WHEN 1 THEN 'Seagull' WHEN 2 THEN '银河 E5' WHEN 3 THEN '001' WHEN 4 THEN 'SU7 Ultra' WHEN 5 THEN '豹5'
         WHEN 6 THEN 'LZW6470X' WHEN 7 THEN 'T03' WHEN 8 THEN 'V' WHEN 9 THEN '' ELSE 'M9' END AS raw_model,
 CASE WHEN m % 5 = 0 THEN concat('EXW ', CAST(amt AS VARCHAR(20)), ' RMB') WHEN m % 5 = 1 THEN concat('$', CAST(amt AS VARCHAR(20)))
      WHEN m % 5 = 2 THEN CAST(amt AS VARCHAR(20)) WHEN m % 5 = 3 THEN concat('USD ', CAST(amt AS VARCHAR(20)), '.5') ELSE '面议' END AS price_text,
 CASE m % 4 WHEN 0 THEN 'EXW' WHEN 1 THEN 'FCA' WHEN 2 THEN 'FOB' ELSE '' END AS term,
 CASE m % 6 WHEN 0 THEN 'FCA南沙港' WHEN 1 THEN '广州南沙' WHEN 2 THEN 'FOB上海' WHEN 3 THEN '小马奔腾' WHEN 4 THEN '霍尔果斯综合保税区' ELSE '' END AS location_text,
 CASE m % 5 WHEN 0 THEN '3暖阳白/黑+13海域白/黑' WHEN 1 THEN '110白' WHEN 2 THEN '白/黑' WHEN 3 THEN '/' ELSE '灰、蓝' END AS colour_text,
 CASE m % 6 WHEN 0 THEN '现车' WHEN 1 THEN '2-3周' WHEN 2 THEN '45天' WHEN 3 THEN '1个月' WHEN 4 THEN '42' ELSE '' END AS wait_text,
 qty, m
FROM b
"""
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
SQL = "offers AS (" + OFFERS.format(lineitem="lineitem", part="part", supplier="supplier") + ")"
