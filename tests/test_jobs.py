"""Whole jobs over a folder of files."""

import json

from pyspark.sql import functions as F

from tallyforge.plans import jobs
from tallyforge.registry import staged_schema
from tallyforge.sources import files


def test_run_sync_harvest(spark, tmp_path):
    now_ = F.lit("2026-01-02 03:04:05").cast("timestamp")
    folder = tmp_path / "input" / "APT" / "南沙" / "BYD" / "Seagull"
    folder.mkdir(parents=True)
    (folder / "价格表.csv").write_text("﻿品牌,车型,配置,EXW(USD),数量,等待天数\nBYD,Seagull,Flying Edition,68000,10,42\n", "utf-8")
    (folder / "broken.xlsx").write_bytes(b"no zip")
    store = jobs.Store(spark, str(tmp_path / "tables"))
    run = lambda dry: jobs.run(store, str(tmp_path / "input"), str(tmp_path / "out"), now_, dry)
    assert run(True).count() == 1 and store.read("staged", staged_schema()).count() == 0
    assert run(False).count() == 1
    staged = store.read("staged", staged_schema()).collect()
    assert [(r.id, r.brand, r.cost_exw_usd, r.order_wait_days, r.status) for r in staged] == [(1, "BYD", 68000, 42, "pending")]
    assert spark.read.json(str(tmp_path / "out" / "errors")).count() == 1
    left = files.unseen(files.discover(spark, str(tmp_path / "input")), store.read("ledger", jobs.LEDGER))
    assert [r.path.rsplit("/", 1)[1] for r in left.select("path").collect()] == ["broken.xlsx"]
    target = str(tmp_path / "payload")
    assert [(r.batch_no, r.n, r.n_empty) for r in jobs.sync(store, target, now_).collect()] == [(0, 1, 0)]
    record = json.loads(spark.read.parquet(target).collect()[0].record)
    assert record["品牌"] == "BYD" and record["sync_batch_id"] == "20260102_030405"
    assert [r.status for r in store.read("staged", staged_schema()).collect()] == ["synced"]
    assert jobs.sync(store, target, now_).count() == 0
    now = spark.createDataFrame([("r1", "eπ007", "通过"), ("r2", "x", "no")], "record_id string, model string, state string")
    old = spark.createDataFrame([(1, "r1", "old"), (2, "r1", "e-π 007"), (2, "r2", "y")], "snapshot_ts int, record_id string, model string")
    by_record, snapshot = jobs.harvest(store, now, old, "state", F.lit(3))
    assert [(r.record_id, r.n_changes, r.n_distilled) for r in by_record.collect()] == [("r1", 1, 1)] and snapshot.count() == 2
    jobs.harvest(store, now, old, "state", F.lit(3))
    assert [(r.field, r.raw_pattern, r.target_value) for r in store.read("rules", jobs.RULES).collect()] == [("model", "e-π 007", "eπ007")]


def test_learning_loop_and_table_actions(spark, tmp_path):
    """A harvested edit, a learned header, dimensions, responses to a text document: all change the next run."""
    now = F.lit("2026-01-02 03:04:05").cast("timestamp")
    folder = tmp_path / "input" / "APT" / "南沙" / "BYD" / "Seagull"
    folder.mkdir(parents=True)
    (folder / "价格表.csv").write_text("品牌,车型,配置,EXW(USD),堆位\nBYD,Seagull,Flying Edition,9800,10\n", "utf-8")
    (folder / "text.md").write_text("# BYD Dolphin", "utf-8")
    store = jobs.Store(spark, str(tmp_path / "tables"))
    learned = [("header_alias", "", "堆位", "stockQuantity", "x", 1), ("field_override", "variant", "Flying Edition", "Flying", "x", 2), ("field_override", "model", "Dolphin", "Dolphin S", "x", 3)]
    store.replace("rules", spark.createDataFrame(learned, jobs.RULES))
    inner = json.dumps({"candidates": [{"brand": "BYD", "modelName": "Dolphin", "stockQuantity": 3, "priceExw": 9000}]})
    good = json.dumps({"candidates": [{"content": {"parts": [{"text": inner}]}}]})
    path = f"file:{folder}/text.md"
    responses = spark.createDataFrame([(path, 1, "{}"), (path, 2, good)], "doc_id string, attempt int, response string")
    paths = [r.path for r in files.text_documents(spark, str(tmp_path / "input")).collect()]
    responses = responses.withColumn("doc_id", F.lit(next(p for p in paths if p.endswith("text.md"))))
    models = spark.createDataFrame([("byd", "seagull", "M-1")], "brand string, model string, id string")
    variants = spark.createDataFrame([("M-1", "flying edition", "V-7", 1)], "model_id string, variant string, id string, prio long")
    known = jobs.Known(models, variants, None, None, responses)
    out = {r.model: r for r in jobs.run(store, str(tmp_path / "input"), str(tmp_path / "out"), now, known=known).collect()}
    assert (out["Seagull"].model_id, out["Seagull"].variant_id, out["Seagull"].variant, out["Seagull"].stock_quantity) == ("M-1", "V-7", "Flying", 10)
    assert (out["Dolphin S"].stock_quantity, out["Dolphin S"].cost_exw_usd, out["Dolphin S"].model_id) == (3, 9000, "MDL-065")
    assert [(r.model, r.number) for r in store.read("model_ids", jobs.MODEL_IDS).collect()] == [("dolphin s", 65)]  # overrides come before ids
    assert jobs.report(store).first().learned_rules == 3
    ids = {r.model: r.id for r in jobs.list_pending(store).collect()}
    edits = spark.createDataFrame([(ids["Seagull"], "location", "Horgos"), (ids["Seagull"], "nope", "x")], "id long, key string, value string")
    assert [r.key for r in jobs.edit(store, edits).collect()] == ["nope"]
    assert {r.model: r.location for r in jobs.list_pending(store).collect()}["Seagull"] == "Horgos"
    rule = store.read("rules", jobs.RULES).where("field = 'location'").first()
    assert (rule.raw_pattern, rule.target_value) == ("南沙", "Horgos")
    (folder / "报价表.csv").write_text("品牌,车型,EXW(USD)\nBYD,Seal,20000\n", "utf-8")
    again = jobs.run(store, str(tmp_path / "input"), str(tmp_path / "out"), now).collect()
    assert [(r.model, r.model_id, r.location) for r in again] == [("Seal", "MDL-066", "Horgos")]  # ids go on from the last run; the edit of another row's place is now a rule
    assert jobs.list_pending(store).count() == 3 and spark.read.json(str(tmp_path / "out" / "candidates_20260102")).count() == 1
    jobs.delete(store, spark.createDataFrame([(ids["Dolphin S"],)], "id long"))
    jobs.sync(store, str(tmp_path / "payload"), now)
    jobs.clean(store)
    assert store.read("staged", staged_schema()).count() == 0
