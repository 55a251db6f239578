"""Rules files, sinks, snapshots, streams, and registered queries against their SQL."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tallyforge import fixed, registry, rules
from tallyforge.operators import grid, matching, staging
from tallyforge.sources import files, records
from tallyforge.streaming import jobs

DATA = "/root/testdata/sf0.001"


def test_registry_and_templates(spark):
    assert len(registry.registry_schema()) == len(fixed.FIELDS) == 27 and registry.registry_schema()["confidence"].dataType.simpleString() == "double"
    empty, described = records.templates(spark)
    assert empty.count() == 1 and described.count() == 27 and "supplier string" in registry.table_ddl()
    assert registry.registry_table(spark).where(F.size("aliases") > 0).count() == 27


def test_rules_file_and_fallback(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"chinese_to_english_brands": {"乙": "Two", "甲": "One"}}), "utf-8")
    fallback = spark.createDataFrame([(0, "x", "y")], "prio int, key string, value string")
    got = [(r.prio, r.key, r.value) for r in rules.load_rules(spark, str(path), "chinese_to_english_brands", fallback).orderBy("prio").collect()]
    assert got == [(0, "乙", "Two"), (1, "甲", "One")]
    assert rules.load_rules(spark, str(tmp_path / "none.json"), "a", fallback).collect() == fallback.collect()
    assert rules.load_rules(spark, str(path), "other", fallback).collect() == fallback.collect()


def test_override_keeps_the_place(spark):
    more = spark.createDataFrame([(" 问界 ", "M9", "AITO", "M9 Max"), ("新", "X", "New", "X"), ("", "X", "New", "X")], "raw_brand string, raw_model string, brand string, model string")
    base = {(r.raw_brand, r.raw_model): r.prio for r in rules.brand_models(spark).collect()}
    got = {(r.raw_brand, r.raw_model): r for r in rules.brand_models(spark, more).collect()}
    assert got["问界", "m9"].model == "M9 Max" and got["问界", "m9"].prio == base["问界", "m9"] and got["新", "x"].prio > max(base.values()) and len(got) == len(base) + 1


def test_learned_header_rule(spark):
    learned = spark.createDataFrame([(1, "价位", "priceFob")], "prio int, pattern string, field string")
    df = spark.createDataFrame([("EXW价位",)], "h string")
    assert matching.map_headers(df, "h", rules.header_rules(spark, learned)).collect()[0].field == "priceFob"


def test_variant_lookup(spark):
    dim = records.variant_index(spark.createDataFrame([("MDL-1", "Pro Max", None, "V1", 1), ("MDL-1", None, "pro", "V2", 2), ("MDL-1", "pro", None, "V3", 3)], "model_id string, variant string, trim_config string, variant_id string, ord int").withColumn("trim_config_id", F.lit("")).withColumn("record_id", F.lit("r")))
    rows = spark.createDataFrame([(1, "MDL-1", "PRO"), (2, "MDL-1", "pro max plus"), (3, "MDL-1", "zzz"), (4, None, "pro")], "i int, m string, v string")
    got = {r.i: r.variant_id for r in matching.lookup_by_containment(rows, dim, "m", "v").collect()}
    assert got == {1: "V3", 2: "V1", 3: None, 4: None}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "S", "BYD", "", 12000, "f.csv")], "id long, supplier string, brand string, model string, cost_exw_usd long, source_file string")
    records.write_csv(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert tuple(back.columns) == registry.COLUMNS and back.collect()[0].cost_exw_usd == "12000"
    records.write_by_source(rows, str(tmp_path / "json"))
    assert os.path.isdir(tmp_path / "json" / "source_file=f.csv")
    assert json.loads(records.sink_payload(rows).collect()[0].record) == {"供应商": "S", "品牌": "BYD", "EXW美金价": 12000, "素材源文件路径": "f.csv"}
    full = rows.withColumn("variant", F.lit("v")).withColumn("version_type", F.lit("国际版")).withColumn("notes", F.lit("n"))
    for c in ("exterior_color", "interior_color", "location", "cost_fob_usd", "cost_fca_usd"):
        full = full.withColumn(c, F.lit(None).cast("string"))
    assert json.loads(records.composite_payload(full).collect()[0].record) == {"brand": "BYD", "variant": "v", "cost_exw_usd": 12000, "version_type": ["国际版"], "notes": "S BYD v | n"}
    with pytest.raises(PermissionError):
        staging.check_target("prod", ("prod",))


def test_records(spark):
    r = spark.createDataFrame([("r1", '{"a":[{"text":"x"}],"b":{"text":"y"},"c":"z","record_id":"f"}')], "record_id string, fields_json string")
    flat = records.flatten_records(r)
    assert flat.collect()[0].fields == {"a": "x", "b": "y", "c": "z", "record_id": "f"}
    for m in records.META[1:]:
        flat = flat.withColumn(m, F.lit("m"))
    assert records.hoist_metadata(flat).collect()[0].row["record_id"] == "f"
    snaps = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "snapshot_ts int, v string")
    assert sorted(x.v for x in records.latest_snapshot(snaps).collect()) == ["b", "c"]


def test_text_documents_and_ledger(spark, tmp_path):
    (tmp_path / "APT.md").write_text("# BYD Seagull\nPrice: 69800", "utf-8")
    doc = files.text_documents(spark, str(tmp_path)).collect()[0]
    assert doc.supplier == "APT" and doc.text.startswith("# BYD")
    found = spark.createDataFrame([("/a/x.csv", "h1"), ("/b/y.csv", "h1"), ("/b/z.csv", "h2")], "path string, content_hash string")
    ledger = spark.createDataFrame([("h2",)], "content_hash string")
    assert [r.content_hash for r in files.unseen(found, ledger).distinct().select("content_hash").distinct().collect()] == ["h1"]
    assert [(r.filename, r.content_hash) for r in staging.ledger_rows(found, ledger, F.current_timestamp()).collect()] == [("x.csv", "h1")]


def test_incremental_ingest(spark, tmp_path):
    root = tmp_path / "input" / "S" / "南沙" / "BYD" / "m"
    root.mkdir(parents=True)
    (root / "a.csv").write_text("品牌,车型,EXW\nBYD,海豚,15000\n", "utf-8")
    (root / "copy.csv").write_text("品牌,车型,EXW\nBYD,海豚,15000\n", "utf-8")
    parse = lambda batch: grid.parse_cells(files.split_errors(files.read_cells(batch))[0], rules.header_rules(spark)).select("modelName", "priceExw")
    write = jobs.stage_then_ledger(parse, str(tmp_path / "staged"), str(tmp_path / "ledger"))
    for name, rows in ((None, 1), ("b.csv", 2)):
        if name:
            (root / name).write_text("品牌,车型,EXW\nBYD,海豹,22000\n", "utf-8")
        stream = jobs.once_by_content(jobs.new_files(spark, str(tmp_path / "input")))
        jobs.run_available(stream, str(tmp_path / "checkpoint"), write).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "staged")).count() == rows
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2


NAMES = ("to_number", "date_normalise", "trade_price_usd", "price_ladder", "brand_translate", "model_map", "location_canon", "header_map", "colour_explode", "priceless_collapse", "model_ids", "apply_edits", "snapshot_diff", "rule_upsert", "telemetry", "first_valid_attempt", "stream_dedup", "year_month", "path_meta",
    "sheet_select", "text_rows_kept", "listing_fields", "guide_price", "price_keys", "noise_rows", "model_in_brand", "official_names", "variant_lookup", "payload_keys", "learned_overrides", "rules_file", "json_walk", "stage_append", "latest_snapshot", "sinks_read_back", "variant_choice",
    "rule_index", "csv_lines", "edits_at_read", "harvest_rules", "bad_files", "json_sink")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    df = __spark_entry__.queries()[name](spark, DATA)
    cursor = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted(cursor.fetchall(), key=key)
