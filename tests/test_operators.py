"""Rules, identity, variants and whole listings on small tables."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyforge import rules
from tallyforge.operators import candidates, changes, grid, identity, matching, staging, validation
from tallyforge.sources import files


@pytest.fixture(scope="module")
def tables(spark):
    return {"brands": rules.brand_names(spark), "models": rules.brand_models(spark), "codes": rules.code_prefixes(spark), "valid": rules.valid_brands(spark)}


def test_headers(spark):
    rows = ["指导价", "提货地点", "外观色", "生产年份", "manufacture_month", "合计", "序号", None, "xyz"]
    want = ["officialSuggestedPriceCny", "location", "exteriorColor", "manufactureYear", "manufactureMonth", None, None, None, None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, h string")
    got = matching.map_headers(df, "h", rules.header_rules(spark)).orderBy("i").collect()
    assert [r.field for r in got] == want


def test_identity(spark, tables):
    cases = [("2025款\nA7", "2025款150探索+", "Geely", "Galaxy A7"), ("吉利牛仔", "2026款观野版", "Geely", "Cowboy"), ("问界", "M9", "AITO", "M9"), ("方程豹", "豹5", "Fangchengbao", "Leopard 5"), ("五菱", "LZW6470X", "Wuling", "Starlight S"), ("零跑", "T03", "Leapmotor", "T03"), (None, None, None, None)]
    df = spark.createDataFrame([(i, b, m) for i, (b, m, _, _) in enumerate(cases)], "i int, b string, m string")
    got = identity.resolve_identity(df, "b", "m", tables["brands"], tables["models"], tables["codes"]).orderBy("i").collect()
    assert [(r.resolved_brand, r.resolved_model) for r in got] == [(b, m) for _, _, b, m in cases]


def test_variants(spark, tables):
    cases = [("430km", "Leapmotor", "T03", None), ("49.92kWh", "BYD", "Dolphin", None), ("FOB 14700", "BYD", "Dolphin", None), ("220000", "BYD", "Dolphin", None), ("LV2", "BYD", "Dolphin", None), ("Qiyuan A07 730旗舰型", "Changan", "Qiyuan A07", "730旗舰型"), ("T032025款310舒享版", "Leapmotor", "T03", "2025款310舒享版"), ("短轴低顶-行镖版", "Farizon", "Xingxiang V", "短轴低顶-行镖版"), ("中轴低顶", "Farizon", "Xingxiang V", None), ("Qiyuan A07 730旗舰型 | 220000 | 宁德83kWh", "Changan", "Qiyuan A07", "730旗舰型")]
    df = spark.createDataFrame([(i, v, b, m) for i, (v, b, m, _) in enumerate(cases)], "i int, _variant_text string, brand string, model string")
    df = df.withColumn("_raw_brand", F.col("brand")).withColumn("_raw_model", F.col("model")).withColumn("_note", F.lit(None).cast("string")).withColumn("_context", F.array().cast("array<string>"))
    got = candidates.with_variants(df, tables["models"]).orderBy("i").collect()
    assert [r.variant for r in got] == [c[3] for c in cases]
    assert "220000" in got[-1].notes and "宁德83kWh" in got[-1].notes


CSV = "﻿品牌,车型,配置,EXW(USD),数量,等待天数\nBYD,Seagull,Flying Edition,68000,10,42\n合计,,,,10,\n"


def cells_of(spark, tmp_path, name, data, folder="input/APT/南沙/BYD/Seagull"):
    p = tmp_path / folder
    p.mkdir(parents=True, exist_ok=True)
    (p / name).write_bytes(data)
    return files.read_cells(files.discover(spark, str(tmp_path)))


def test_csv_to_candidates(spark, tmp_path, tables):
    cells, errors = files.split_errors(cells_of(spark, tmp_path, "价格表.csv", CSV.encode()))
    assert errors.count() == 0
    raw = grid.parse_cells(cells, rules.header_rules(spark))
    row = raw.collect()[0]
    assert raw.count() == 1 and (row.brand, row.modelName, row.variant, row.priceExw, row.supplier, row.location) == ("BYD", "Seagull", "Flying Edition", "68000", "APT", "南沙")
    out = candidates.format_candidates(raw, tables["brands"], tables["models"], tables["codes"], tables["valid"]).collect()
    assert len(out) == 1
    c = out[0]
    assert (c.brand, c.model, c.variant, c.cost_exw_usd, c.order_wait_days, c.status_vehicle, c.stock_quantity, c.model_id, c.variant_id) == ("BYD", "Seagull", "Flying Edition", 68000, 42, "在途", 10, "MDL-065", "MDL-065-V01")


def test_bad_file_is_reported(spark, tmp_path):
    _, errors = files.split_errors(cells_of(spark, tmp_path, "x.xlsx", b"no zip"))
    assert [r.path.rsplit("/", 1)[1] for r in errors.collect()] == ["x.xlsx"]


def workbook(sheets):
    out = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, (rows, merge) in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>' for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData>" + (f'<mergeCells><mergeCell ref="{merge}"/></mergeCells>' if merge else "") + "</worksheet>")
    return out.getvalue()


def test_workbook(spark, tmp_path):
    data = workbook({"汇总": ([["品牌", "车型", "FOB"], ["BYD", "海豚", 15000], [None, "海豹", 22000]], "A2:A3"), "说明": ([["x"]], None)})
    cells, _ = files.split_errors(cells_of(spark, tmp_path, "a.xlsx", data, "input/S/南沙/BYD/m"))
    raw = {r.modelName: r for r in grid.parse_cells(cells, rules.header_rules(spark)).collect()}
    assert set(raw) == {"海豚", "海豹"} and raw["海豹"].brand == "BYD" and raw["海豹"].priceFob == "22000"


def test_vertical_and_text_sheets(spark, tmp_path):
    rows = [["项目名称", "海豚"], ["品牌", "比亚迪"], ["电池", "44kWh"], ["颜色", "白"], ["售价", "99800"], ["x", None]]
    text = [["Smart #1 Pro"], ["RMB 189,900"], ["EXW 25000"], ["Smart #3 Pro EXW 26000"]]
    data = workbook({"a": (rows, None), "b": (text, None)})
    cells, _ = files.split_errors(cells_of(spark, tmp_path, "a.xlsx", data, "input/S/南沙/Smart/价格"))
    raw = grid.parse_cells(cells, rules.header_rules(spark)).orderBy("sheet", "row_no").collect()
    assert [r._type for r in raw] == ["vertical_parameter", "unstructured_text", "unstructured_text", "unstructured_text"]
    assert raw[0].model == "海豚" and raw[0].exteriorColor == "白" and "电池: 44kWh" in raw[0].notes
    assert [(r.model, r.priceExw, r.officialSuggestedPriceCny) for r in raw[1:]] == [("Smart #1", None, "189900"), ("Smart #1", "25000", None), ("Smart #3", "26000", None)]


def test_merged_fill(spark):
    cells = spark.createDataFrame([("p", "s", 1, 1, "x"), ("p", "s", 2, 2, "own"), ("p", "s", 2, 1, None)], "path string, sheet string, row_no int, col_no int, value string")
    merges = spark.createDataFrame([("p", "s", 1, 2, 1, 1)], "path string, sheet string, min_row int, max_row int, min_col int, max_col int")
    got = {(r.row_no, r.col_no): r.value for r in grid.fill_merged(cells, merges).collect()}
    assert got == {(1, 1): "x", (2, 1): "x", (2, 2): "own"}


def test_dedup_is_idempotent(spark):
    row = {c: None for c in candidates.CANDIDATE}
    kinds = {c: "long" if c in ("stock_quantity", "supplier_price_cny", "cost_exw_usd", "cost_fob_usd", "cost_fca_usd") else "string" for c in candidates.CANDIDATE}
    rows = [{**row, "brand": "B", "model": "M", "supplier": s, "n": i} for i, s in enumerate(["S", "S", "", None])]
    df = spark.createDataFrame([tuple(r[c] for c in (*candidates.CANDIDATE, "n")) for r in rows], ", ".join(f"{c} {kinds[c]}" for c in candidates.CANDIDATE) + ", n int")
    once = candidates.dedup_candidates(df, ["n"])
    assert sorted(r.n for r in once.collect()) == [0, 2]
    assert candidates.dedup_candidates(once, ["n"]).count() == 2


def test_staging(spark):
    rows = spark.range(25).select(F.col("id").cast("string").alias("supplier"), F.lit("x").alias("brand")).repartition(4)
    staged = staging.stage(rows, 100, F.lit("2026-01-01").cast("timestamp"))
    ids = sorted(r.id for r in staged.collect())
    assert ids == list(range(101, 126))
    table = spark.createDataFrame(staged.select("id", "supplier", "brand", "status").collect())
    good, bad = staging.split_edits(spark.createDataFrame([(101, "brand", "BYD"), (102, "brand", None), (101, "nope", "1")], "id long, key string, value string"))
    edited = {r.id: r.brand for r in staging.apply_edits(table, good).collect()}
    assert bad.count() == 1 and edited[101] == "BYD" and edited[102] is None and edited[103] == "x"
    synced = staging.transition(table, spark.createDataFrame([(101,)], "id long"))
    assert synced.where("status = 'synced'").count() == 1 and staging.delete_rows(table, synced.where("status = 'synced'").select("id")).count() == 24
    assert sorted(r["count"] for r in staging.batches(table.withColumn("id", F.col("id") - 100), 10).groupBy("batch_no").count().collect()) == [5, 10, 10]


def test_changes(spark):
    base = spark.createDataFrame([(1, "e-π 007", "a"), (2, "x", "b")], "record_id long, model string, brand string")
    now = spark.createDataFrame([(1, "eπ007", " a "), (2, "x", ""), (3, "new", "c")], "record_id long, model string, brand string")
    got = {(r.record_id, r.field): (r.old_value, r.new_value) for r in changes.field_changes(base, now, "record_id", ["model", "brand"]).collect()}
    assert got == {(1, "model"): ("e-π 007", "eπ007"), (2, "brand"): ("b", None)}
    assert changes.field_changes(base, base, "record_id", ["model", "brand"]).count() == 0
    edits = spark.createDataFrame([("model", "e-π 007", "eπ007", None, 1), ("model", "e-π 007 ", "eπ008", "later", 2)], "field string, old_value string, new_value string, context string, ord int")
    learned = changes.distil(edits)
    rule = changes.upsert_rules(learned.where("ord = 1"), learned.where("ord = 2")).collect()
    assert len(rule) == 1 and (rule[0].target_value, rule[0].context, rule[0].ord) == ("eπ008", "cli_edit", 1)
    assert changes.apply_overrides(base, changes.upsert_rules(learned.where("ord = 1"), learned.where("ord > 9")), ["model"]).where("model = 'eπ007'").count() == 1


def test_telemetry(spark):
    none = changes.telemetry(spark.createDataFrame([], "deterministic long, ai long")).collect()[0]
    assert (none.total, none.deterministic_pct, none.ai_pct) == (0, 100.0, 0.0)
    some = changes.telemetry(spark.createDataFrame([(9, 1), (10, 0)], "deterministic long, ai long")).collect()[0]
    assert (some.total_runs, some.total, some.deterministic_pct, some.ai_pct) == (2, 20, 95.0, 5.0)


def envelope(inner):
    import json

    return json.dumps({"candidates": [{"content": {"parts": [{"text": inner}]}}]})


def test_attempts(spark):
    ok, bad, empty = envelope('{"candidates":[{"brand":"BYD","stockQuantity":3}]}'), envelope('{"candidates":[{"stockQuantity":{"a":1}}]}'), envelope('{"candidates":[]}')
    rows = [(1, 1, bad), (1, 2, ok), (2, 1, bad), (2, 2, envelope("no json")), (2, 3, "{}"), (3, 1, ok), (4, 1, empty), (4, 2, empty), (4, 3, empty)]
    checked = validation.check_responses(spark.createDataFrame(rows, "doc_id long, attempt int, response string"))
    got = {r.doc_id: (r.attempt, r.needs_human_review) for r in validation.first_valid(checked).collect()}
    assert got == {1: (2, False), 2: (None, True), 3: (1, False), 4: (3, False)}
    parsed = validation.parse_payload(validation.first_valid(checked)).collect()
    assert {(r.doc_id, r.brand, r.stockQuantity) for r in parsed} == {(1, "BYD", 3), (3, "BYD", 3)}


def test_enum(spark):
    df = spark.createDataFrame([("左舵", "国内版", "现车"), ("x", None, "y")], "steering_setup string, version_type string, status_vehicle string")
    assert sorted(len(r.violations) for r in validation.enum_violations(df).collect()) == [0, 2]


def test_ids_survive_repartitioning(spark):
    df = spark.createDataFrame([("b", "y", 3), ("a", "x", 2), ("b", "y", 1), ("c", "z", 5)], "b string, m string, ord int")
    one = {(r.b, r.m): r.id for r in identity.numbered_ids(df, ["b", "m"], "ord").collect()}
    assert one == {("b", "y"): "MDL-065", ("a", "x"): "MDL-066", ("c", "z"): "MDL-067"}
    assert one == {(r.b, r.m): r.id for r in identity.numbered_ids(df.repartition(3), ["b", "m"], "ord").collect()}
