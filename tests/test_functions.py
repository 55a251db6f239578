"""Literal cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import color, dates, location, numbers, price, state, text


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(column).collect()]


def test_to_number(spark):
    rows = ["57800", "$1,234.5", "-5", "10-20", "12万", "1.2.3", ".", "", None, "2.5", "3.5", "9" * 40]
    assert values(spark, numbers.to_number(F.col("x")), rows) == [57800, 1234, 5, 1020, 12, None, None, None, None, 2, 4, None]


def test_wait_days(spark):
    rows = ["现车", "0天", "2-3周", "1.5周", "1-2个月", "1个月", "10至45天", "45天", "42", " ", None, "soon"]
    assert values(spark, numbers.wait_days(F.col("x")), rows) == [0, 0, 21, 10, 60, 30, 45, 45, 42, None, None, None]


def test_dates(spark):
    rows = ["2025年3月5日", "2025.03.05", "2025-3", "2025年款", "x", None, "2025-13-45"]
    assert values(spark, dates.normal_date(F.col("x")), rows) == ["2025-03-05", "2025-03-05", "2025-03-01", None, None, None, "2025-13-45"]
    assert values(spark, dates.epoch_millis(F.col("x")), ["2025-03-05", "2025-13-45"]) == [1741132800000, None]


def test_year_month(spark):
    got = values(spark, dates.manufacture_year_month([F.col("y")], [F.col("m")], [F.col("d"), F.col("e")]), [("2025", "4", None, None), (None, None, "2024年款", "2023-07"), ("3025", "13", None, "2024/2"), (None, None, None, None)], "y string, m string, d string, e string")
    assert [tuple(g) for g in got] == [(2025, 4), (2024, 7), (2024, 2), (None, None)]


def test_noise_and_footer(spark):
    assert values(spark, text.clean_noise(F.col("x")), ["EXW价格表 Seagull.xlsx", "2025款 A7"]) == ["Seagull", "A7"]
    rows = ["1. 以上汇率为境外人民币", "二类底盘含空调及定速巡航", "Dolphin", "", "x" * 41]
    assert values(spark, text.is_invalid_model(F.col("x")), rows) == [True, True, False, True, True]
    assert values(spark, text.compact_key(F.col("x")), ["E-HS 9/x：y", None]) == ["ehs9xy", ""]


def test_colour(spark):
    rows = ["110白", "白/黑", "/", "白(套色)", "3暖阳白/黑+13海域白/黑", None]
    got = [tuple(g) for g in values(spark, color.parse_colour(F.col("x")), rows)]
    assert got == [("白", None, 110), ("白", "黑", None), (None, None, None), ("白", None, None), ("3暖阳白/黑+13海域白/黑", None, None), (None, None, None)]
    parts = values(spark, color.colour_parts(F.col("x")), ["3暖阳白/黑+13海域白/黑+13灰/黑", "白", "白;黑", "白/黑/灰", "；；"])
    assert [tuple(p) for p in parts[0]] == [(3, "暖阳白", "黑"), (13, "海域白", "黑"), (13, "灰", "黑")]
    assert parts[1] is None and [p.exterior for p in parts[2]] == ["白", "黑"] and [p.exterior for p in parts[3]] == ["白", "黑", "灰"] and parts[4] == []


def test_place(spark):
    rows = ["广州南沙基地", "南沙是", "FCA南沙港", "霍尔果斯综合保税区", "小马奔腾", "BYD", "", None, "湘潭"]
    assert values(spark, location.canonical_place(F.col("x")), rows) == ["南沙", "南沙", "南沙", "霍尔果斯", None, None, None, None, "湘潭"]


def test_path_metadata(spark):
    rows = ["/project/input/APT/FCA 南沙/Leapmotor/T03/x.xlsx", "/input/S/x.xlsx"]
    got = [tuple(g) for g in values(spark, location.path_metadata(F.col("x")), rows)]
    assert got == [("APT", "南沙", "Leapmotor", "T03"), ("S", "x.xlsx", None, "x")]


def test_price_bounds_and_ladder(spark):
    assert values(spark, price.in_bounds(F.col("x")), [3, 205, 12500, 1500000], "x long") == [None, None, 12500, None]
    got = values(spark, price.ladder_warnings(F.col("a"), F.col("b"), F.col("c")), [(10000, 10500, 11000), (10000, 10050, None), (10000, 9500, None)], "a long, b long, c long")
    assert [len(g) for g in got] == [0, 1, 1] and "EXW->FCA" in got[1][0] and "$50," in got[1][0]


def test_currency(spark):
    rows = [(31764, "FOB RMB 31764"), (34999, ""), (35000, ""), (50000, "$"), (None, "RMB")]
    assert values(spark, price.is_cny(F.col("v"), F.col("c")), rows, "v long, c string") == [True, False, True, False, False]
    assert values(spark, price.to_usd(F.col("x")), [31764, 32546], "x long") == [4741, 4858]


def test_confidence_and_approval(spark):
    got = values(spark, state.confidence(F.col("g"), F.col("s"), F.lit("BYD"), F.lit("Seagull"), F.col("v"), F.lit("南沙"), F.col("p"), F.lit("左舵"), F.lit("国内版")), [(None, "S", "版", True), (None, None, None, False), ("0.876", "S", "版", True)], "g string, s string, v string, p boolean")
    assert got == [1.0, 0.35, 0.88]
    df = spark.createDataFrame([(["opt-1"],), (["未通过"],), (["no"],), (None,)], "x array<string>").coalesce(1)
    assert [r[0] for r in df.select(state.is_approved(F.col("x"), ("opt-1",))).collect()] == [True, True, False, False]
    assert values(spark, state.json_confidence(F.col("x")), ['{"a":[{"confidence":0.5},{"score":1}]}', "{}"]) == [0.75, 1.0]
    walked = ['{"\\u0063onfidence":0.2}', '{"prob":true,"x":{"score":false}}', '{"confidence":{"score":0.4,"n":"\\"prob\\": 9"}}', '{"confidence":"0.1","score":1e-1}', '[{"score":-2},{"scores":5}]', 'broken {"score": 0.5}', None]
    assert values(spark, state.json_confidence(F.col("x")), walked)[:6] == [0.2, 0.5, 0.4, 0.1, -2.0, 0.5]


def test_availability(spark):
    got = values(spark, state.availability(F.col("x"), F.col("y")), [("2-3周", None), ("现车", None), ("", "12"), ("", None)], "x string, y string")
    assert [tuple(g) for g in got] == [(21, "在途"), (0, "现车"), (12, "在途"), (None, "无具体信息")]


@pytest.mark.parametrize("scope, version, steer", [("出口 RHD", "国际版", "右舵"), ("x", "国内版", "左舵")])
def test_version_and_steering(spark, scope, version, steer):
    assert values(spark, state.version_type(F.col("x")), [scope]) == [version]
    assert values(spark, state.steering(F.col("x")), [scope]) == [steer]
