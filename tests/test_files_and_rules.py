"""Workbooks, CSV by lines, the index of rules, ids that last, and the order of rules and edits."""

import random
import re
import tracemalloc
import zipfile
from collections import Counter
from datetime import date, datetime, timedelta
from io import BytesIO

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge import rules
from tallyforge.functions import dates
from tallyforge.operators import deltas, durable_ids, identity, matching, staging, substrings
from tallyforge.plans import jobs
from tallyforge.registry import staged_schema
from tallyforge.sources import csv_text, files, workbooks


def book(sheet_xml, styles=None, workbook_pr="", strings=None):
    out = BytesIO()
    main, office = workbooks._MAIN, workbooks._OFFICE
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}">{workbook_pr}<sheets><sheet name="a" sheetId="1" r:id="r1"/><sheet name="chart" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="r1" Type="{office}/worksheet" Target="/xl/worksheets/one.xml"/><Relationship Id="r2" Type="{office}/chartsheet" Target="chartsheets/c.xml"/></Relationships>')
        z.writestr("xl/worksheets/one.xml", f'<worksheet xmlns="{main}">{sheet_xml}</worksheet>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')
        if strings:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{strings}</sst>')
    return out.getvalue()


@pytest.mark.parametrize(
    "code, kind",
    [("General", None), ("0.00E+00", None), ("yyyy-mm-dd", "d"), ("[$-409]d\\-mmm;@", "d"), ("[Red]0.0", None), ('"day"0', None), ("[h]:mm:ss", "t"), ("[<=9]0;0", None), ("_(* #,##0_)", None), ('0;"d"', None), ("@", None), ("h:mm AM/PM", "d")],
)
def test_date_formats(code, kind):
    assert workbooks.is_date_format(code) == kind


def test_serials_by_the_calendar():
    rng = random.Random(1)
    for _ in range(200):
        at = datetime(1900, 3, 1) + timedelta(seconds=rng.randrange(8 * 10**9))
        serial = (at - datetime(1899, 12, 30)) / timedelta(days=1)
        assert workbooks.serial_date(serial, False) == (at.isoformat(), "d")
        assert workbooks.serial_date(serial - 1462, True)[0] == at.isoformat() or serial < 1463
    assert workbooks.serial_date(59, False)[0] == "1900-02-28T00:00:00" and workbooks.serial_date(0.25, False) == ("06:00:00", "t")


def test_cells_of_a_workbook():
    styles = '<numFmts><numFmt numFmtId="200" formatCode="yyyy&quot;年&quot;"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="200"/><xf numFmtId="46"/></cellXfs>'
    strings = "<si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si>"
    xml = """<sheetData><row><c><v>7</v></c><c s="1"><v>45735</v></c><c t="s"><v>0</v></c></row><row r="4"><c r="B4" s="2"><v>45735.75</v></c><c r="C4" t="str"><v>f</v></c><c r="D4" t="b"><v>1</v></c><c r="E4" t="e"><v>#N/A</v></c></row>
      <row r="5"><c r="A5"><f>1+1</f></c></row><row r="9"><c r="A9" t="d"><v>2025-03-19T01:02:03</v></c><c r="B9"><v>1.5E3</v></c><c r="C9" s="3"><v>1.5</v></c><c r="D9" s="1"><v>-3</v></c></row></sheetData>
      <mergeCells><mergeCell ref="B1:B3"/><mergeCell ref="F7:G8"/></mergeCells>"""
    got = [(r, c, v, k, m) for _, _, r, c, v, k, m in workbooks.workbook_cells(book(xml, styles, strings=strings))]
    assert got == [
        (1, 1, "7", "n", False), (1, 2, "2025-03-19T00:00:00", "d", True), (1, 3, "rich", "s", False), (2, 2, "2025-03-19T00:00:00", "d", True), (3, 2, "2025-03-19T00:00:00", "d", True),
        (4, 2, "2025-03-19T18:00:00", "d", False), (4, 3, "f", "s", False), (4, 4, "True", "b", False), (4, 5, "#N/A", "s", False),
        (5, 1, "2025-03-19T01:02:03", "d", False), (5, 2, "1500.0", "n", False), (5, 3, "36:00:00", "t", False), (5, 4, "-3", "n", False),
    ]
    old = book('<sheetData><row r="1"><c r="A1" s="1"><v>44273</v></c></row></sheetData>', styles, '<workbookPr date1904="1"/>')
    assert [c[4] for c in workbooks.workbook_cells(old)] == ["2025-03-19T00:00:00"]
    assert list(workbooks.workbook_cells(book("<sheetData/>"))) == []


def test_round_trip_and_damage(spark):
    cells = [("p.xlsx", "s <1>", 1, 1, 1, "日 & x", "s"), ("p.xlsx", "s <1>", 1, 2, 2, "1999-12-31T23:59:59", "d"), ("p.xlsx", "two", 2, 1, 28, " in ", "i"), ("q.xlsx", "a", 1, 5, 1, "0:00:09", "t")]
    made = workbooks.to_workbooks(spark.createDataFrame(cells, "path string, sheet string, sheet_no int, row_no int, col_no int, value string, kind string"))
    whole = made.withColumn("length", F.length("content"))
    broken = whole.withColumn("path", F.concat(F.lit("broken "), "path")).withColumn("content", F.expr("substring(content, 1, length(content) - 30)"))
    good, bad = files.split_errors(files.read_cells(files.fingerprinted(whole.unionByName(broken))))
    assert {(r.path, r.sheet, r.row_no, r.col_no, r.value, r.kind) for r in good.collect()} == {(p, s, r if p == "p.xlsx" else 1, c, v, "s" if k == "i" else k) for p, s, _, r, c, v, k in cells}
    assert {r.path for r in bad.collect()} == {"broken p.xlsx", "broken q.xlsx"}
    days = good.where("kind = 'd'").select(dates.normal_date(F.col("value")).alias("d")).collect()
    assert [r.d for r in days] == [date(1999, 12, 31).isoformat()]


def test_workbooks_pass_by_without_being_held():
    data = (b"a,b,c,d\n" * 100_000)
    frame = type("Frame", (), {"select": lambda self, *a: self, "mapInArrow": lambda self, f, schema: f})()
    batch = pa.RecordBatch.from_pydict({"path": ["x.csv"], "content_hash": ["h" * 64], "content": [data]})
    before, most, n = pa.total_allocated_bytes(), 0, 0
    for cells in files.read_cells(frame)(iter([batch])):
        most, n = max(most, pa.total_allocated_bytes() - before), n + cells.num_rows
    assert n == 400_000 and most < 15_000_000  # all the columns take 50 MB
    tracemalloc.start()
    made = workbooks._Book({"s": ["A1:B1"]})
    for r in range(1, 20_001):
        for c in (1, 2, 3):
            made.add("s", 1, r, c, f"text {r % 1000} {c}", "i")
    content = made.close()
    assert tracemalloc.get_traced_memory()[1] < 3_000_000 + 3 * len(content)
    tracemalloc.clear_traces()
    assert sum(1 for _ in workbooks.workbook_cells(content)) == 60_000
    assert tracemalloc.get_traced_memory()[1] < 3_000_000
    tracemalloc.stop()


def test_sheets_in_any_order_and_texts_beyond_the_shared_ones(spark, monkeypatch):
    cells = [("p", "z", 1, 3, 1, "later", "s"), ("p", "a", 2, 1, 2, "x", "s"), ("p", "z", 3, 2, 1, "2", "n"), ("p", "a", 2, 1, 1, None, "s"), ("q", "m", 1, 1, 1, "True", "b"), ("p", "z", 1, 2, 2, "b", "s"), ("q", "m", 1, 1, 3, "x", None)]
    merges = [("p", "a", 1, 1, 2, 3), ("p", "none", 1, 1, 1, 2)]
    made = workbooks.to_workbooks(spark.createDataFrame(cells, "path string, sheet string, sheet_no int, row_no int, col_no int, value string, kind string"), spark.createDataFrame(merges, "path string, sheet string, min_row int, max_row int, min_col int, max_col int"))
    read = {r.path: list(workbooks.workbook_cells(bytes(r.content))) for r in made.collect()}
    assert read == {"p": [("z", 1, 1, 1, "2", "n", False), ("z", 1, 1, 2, "b", "s", False), ("z", 1, 2, 1, "later", "s", False), ("a", 2, 1, 2, "x", "s", True), ("a", 2, 1, 3, "x", "s", True)], "q": [("m", 1, 1, 1, "True", "b", False), ("m", 1, 1, 3, "x", "s", False)]}
    monkeypatch.setattr(workbooks, "MOST_SHARED", 5)
    few = workbooks._Book({})
    texts = ["abc", "", "defg <", "abc", " z "]
    for c, t in enumerate(texts, 1):
        few.add("s", 1, 1, c, t, "s")
    assert [x[4:6] for x in workbooks.workbook_cells(few.close())] == [(t, "s") for t in texts] and list(few.shared) == ["abc", ""]


def test_csv_by_lines_equals_whole_files(spark, tmp_path):
    rng = random.Random(1)
    simple, tricky = ["a", "", "车型", '"q"', '"a,b"', '"x ""y"" z"', '""', " lead", '"",""', "é"], ['"open\nline"', 'a"b', '"a"b', 'a "b"', '"\r\n"']
    for i in range(24):
        body = [",".join(rng.choice(simple + (tricky if i % 4 == 3 and rng.random() < 0.05 else [])) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(200))]
        data = rng.choice(["\n", "\r\n", "\r"]).join(body).encode()
        data = b"\xef\xbb\xbf" + data if i % 5 == 0 else data
        data = data.replace("é".encode(), b"\xe9") if i % 7 == 6 else data
        data = {12: b"\xef\xbb\xbf\n\xef\xbb\xbfx,y\n", 13: b"", 16: b"a," + b"z" * 140_000 + b"\nb"}.get(i, data)
        folder = tmp_path / f"s={i % 3}"
        folder.mkdir(exist_ok=True)
        (folder / (f"f [{i}]+%20.CSV" if i % 2 else f"é{i}.csv")).write_bytes(data)
    (tmp_path / "big.csv").write_bytes(b"\n".join(b'r%d,"a,%d",' % (i, i) if i % 3 else b",," for i in range(9000)))
    (tmp_path / "other.txt").write_text("no")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # so that files are read in parts
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        hashes = files.discover(spark, str(tmp_path), ("csv",)).select("path", "content_hash")
        got = Counter(tuple(r) for r in csv_text.read_csv_cells(spark, str(tmp_path), hashes=hashes).collect())
        assert got == Counter(tuple(r) for r in files.read_cells(files.discover(spark, str(tmp_path), ("csv",))).collect()) and len(got) > 9000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rules_by_index_equal_the_loop(spark):
    rng = random.Random(3)
    letters = "ab车😀 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(80)] + [None, "", "a", "evx ev"]
    pats = ["".join(rng.choice(letters) for _ in range(rng.randrange(7))) for _ in range(60)] + [None, "ev", "zzz", "zz", "z"]
    df = spark.createDataFrame([(i, t, texts[-1 - i]) for i, t in enumerate(texts)], "i int, t string, u string").repartition(3)
    table = spark.createDataFrame([(i // 2, p, f"rule {i}") for i, p in enumerate(pats)], "prio int, p string, named string")
    hit = lambda: F.col("t").contains(F.col("p")) | F.col("u").contains(F.replace("p", F.lit("ev"), F.lit("")))
    inside = [(["t"], F.col("p")), (["u"], F.replace("p", F.lit("ev"), F.lit("")))]
    run = lambda f, **more: {r.i: r.named for r in f(df, ["t", "u"], table, hit, ["named"], **more).select("i", "named").collect()}
    want = {}
    for i, t in enumerate(texts):
        u = texts[-1 - i]
        fit = [(k // 2, f"rule {k}") for k, p in enumerate(pats) if p is not None and ((t is not None and p in t) or (u is not None and p.replace("ev", "") in u))]
        want[i] = min(fit)[1] if fit else None
    assert run(matching.first_match_join) == run(matching.first_match_join, within=inside, most=0) == want
    keys = matching.first_match_on_keys(df.select("t", "u").distinct(), table, hit, ["named"], within=inside, most=0)
    assert {(r.t, r.u): r.named for r in keys.collect()} == {(texts[i], texts[-1 - i]): v for i, v in want.items()}
    found = matching.first_match_join(df, ["t", "u"], table, hit, ["named"], within=inside, most=0)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert substrings.candidates(df.limit(0), table, inside).count() == 0


def joined_rows(df):
    """The rows that the largest join of a plan made."""
    df.collect()

    def walk(p):
        while (name := p.nodeName()) == "AdaptiveSparkPlan" or "QueryStage" in name:
            p = p.plan() if "QueryStage" in name else p.executedPlan()
        made = [p.metrics().get("numOutputRows").get().value()] if "Join" in p.nodeName() else []
        return made + [n for i in range(p.children().size()) for n in walk(p.children().apply(i))]

    return max(walk(df._jdf.queryExecution().executedPlan()))


def test_numbers_in_texts_meet_the_rules_inside_them_alone(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789") for _ in range(12)) for _ in range(300)]
    pats = {"".join(rng.choice("0123456789") for _ in range(6)) for _ in range(20_000)}  # a run of three digits stands in eighty of them
    keys, table = spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame([(p,) for p in pats], "p string")
    met = substrings.candidates(keys, table, [(["t"], F.col("p"))])
    assert sorted((r.t, r.p) for r in met.distinct().collect()) == sorted((t, p) for t in texts for p in {t[i : i + 6] for i in range(7)} & pats)
    assert joined_rows(met) < 10_000


def test_rules_in_two_rounds_equal_the_loop(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ab车😀") for _ in range(n))
    texts = [f"https://host/{word(rng.randrange(20))}" for _ in range(60)] + [None, "", "none of them"]
    pats = [t[at : at + rng.randrange(3, 22)] for t in texts[:30] for at in (9, 12, 15) if len(t) > at + 6] + [t for t in texts[:9]] + [f"https://host/{word(9)}" for _ in range(40)] + ["a 车 that no text holds", None, None]
    rng.shuffle(pats)
    table = spark.createDataFrame([(i // 2 if i else None, p, f"rule {i}") for i, p in enumerate(pats * 2)], "prio int, p string, named string")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    run = lambda **more: {r.i: r.named for r in matching.first_match_join(df, ["t"], table, lambda: F.col("t").contains(F.col("p")), ["named"], within=[(["t"], F.col("p"))], **more).select("i", "named").collect()}
    want = run()
    assert len({v for v in want.values()}) > 5 and None in want.values()
    monkeypatch.setattr(matching, "FIRST_RULES", 7)
    assert run(most=0) == want
    monkeypatch.setattr(substrings, "SMALL", 0)
    assert run(most=0, reads=["p"]) == want


def test_lookups_agree_beyond_a_broadcast(spark, monkeypatch):
    listed = [("比亚迪海豚", "dolphin 420km"), ("BYD", "Seagull 430"), ("五菱", "LZW6470X"), ("Geely Auto", "Galaxy E5"), ("问界", "M9"), ("nope", "x"), (None, None), ("零跑", "T03 ev"), ("吉利银河", "a7")]
    df = spark.createDataFrame(listed, "b string, m string")
    run = lambda: sorted(map(str, identity.resolve_identity(df, "b", "m", rules.brand_names(spark), rules.brand_models(spark), rules.code_prefixes(spark)).collect()))
    few = run()
    monkeypatch.setattr(matching, "BROADCAST_RULES", 0)
    assert run() == few


def test_override_places_are_distinct(spark):
    more = spark.range(60_000).select(F.concat(F.lit("b"), "id").alias("raw_brand"), F.lit("m").alias("raw_model"), F.lit("B").alias("brand"), F.col("id").cast("string").alias("model"), "id")
    twice = more.withColumn("ord", F.col("id")).unionByName(more.where("id < 3").withColumn("model", F.lit("last")).withColumn("ord", F.col("id") + 10**6))
    got = rules.brand_models(spark, twice)
    assert got.select("prio").distinct().count() == got.count()
    assert {r.model for r in got.where("raw_brand in ('b0', 'b1', 'b2')").collect()} == {"last"}


def test_learned_headers_win_at_any_place(spark):
    df = spark.createDataFrame([("报价EXW",)], "h string")
    built_in = matching.map_headers(df, "h", rules.header_rules(spark)).first().field
    for at in (1, 1_500_000, 1 << 40):
        learned = spark.createDataFrame([(at, "报价", "notes")], "prio long, pattern string, field string")
        assert matching.map_headers(df, "h", rules.header_rules(spark, learned)).first().field == "notes" != built_in


def test_first_places_are_found_without_sorting_the_table(spark, tmp_path):
    rows = [(k, o) for k, o in zip("abcdefgh", [(5, 1), (5, -1), (None, 2), (-(2**63), None), (2**63 - 1, 2**31 - 1), (-(2**63), -(2**31)), None, (5, None)])]
    seen = spark.createDataFrame([(k, o) for k, o in rows] + [("a", (2**63 - 1, 7)), ("h", (5, 0))], "k string, o struct<x: long, y: int>")
    none = spark.createDataFrame([], "k string, number long")
    first = durable_ids.unknown_keys(none, seen, ["k"], "o")
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    by_struct = [r.k for r in seen.groupBy("k").agg(F.min("o").alias("o")).orderBy("o", "k").collect()]
    assert [r.k for r in first.orderBy("_first", "k").collect()] == by_struct == list("gcdfhbae")
    assert [r.k for r in durable_ids.new_numbers(none, seen, ["k"], "o").orderBy("number").collect()] == by_struct
    store = jobs.Store(spark, str(tmp_path))
    for _ in range(2):
        got = jobs.register(store, "variant_ids", "k string, number long", seen, "o")
    assert sorted((r.number, r.k) for r in got.collect()) == list(enumerate(by_struct, 1)) and [k for _, k in store._parts("variant_ids")] == [0, 1]


def test_numbers_go_on(spark):
    known = spark.createDataFrame([("x", "a", 7), ("y", "c", 2)], "m string, v string, number long")
    seen = spark.createDataFrame([("x", "b", 5), ("x", "a", 0), ("y", "d", 9), ("y", "e", 1), ("z", "f", 3), (None, "g", 0), ("y", "d", 0)], "m string, v string, o int")
    rows = lambda df: sorted((r.m, r.v, r.number) for r in df.collect())
    assert rows(durable_ids.new_numbers(known, seen, ["m", "v"], "o", start=65)) == [("x", "b", 68), ("y", "d", 65), ("y", "e", 66), ("z", "f", 67)]
    grouped = durable_ids.new_numbers(known, seen, ["m", "v"], "o", ["m"])
    assert rows(grouped) == [("x", "b", 8), ("y", "d", 3), ("y", "e", 4), ("z", "f", 1)]
    assert durable_ids.new_numbers(known.unionByName(grouped), seen, ["m", "v"], "o", ["m"]).count() == 0


def test_ids_last_over_runs(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    numbering = jobs.numbering(store)
    ids = {}
    for i, rows in enumerate([[("byd", "dolphin", "a", 2), ("byd", "seal", "a", 1)], [("leap", "t03", "b", 1), ("byd", "dolphin", "b", 2)], [("leap", "t03", "b", 1)]]):
        seen = spark.createDataFrame(rows, "b string, m string, v string, o int")
        named = seen.join(numbering.models(seen, ["b", "m"], "o").withColumnRenamed("id", "model_id"), ["b", "m"])
        variants = numbering.variants(named, "model_id", "v", "o").withColumnRenamed("id", "variant_id")
        ids[i] = sorted((r.b, r.m, r.model_id, r.variant_id) for r in named.join(variants, ["model_id", "v"]).collect())
    assert ids[0] == [("byd", "dolphin", "MDL-066", "MDL-066-V01"), ("byd", "seal", "MDL-065", "MDL-065-V01")]
    assert ids[1] == [("byd", "dolphin", "MDL-066", "MDL-066-V02"), ("leap", "t03", "MDL-067", "MDL-067-V01")] and ids[2] == ids[1][1:]


def test_the_last_edit_is_the_rule(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "A"), (2, "A")], "id long, model string")
    store.replace("staged", staging.evolve(spark.createDataFrame([], staged_schema()), rows))
    edits = [(1, "model", f"B{i}") for i in range(9)] + [(2, "model", "last"), (2, "model", None), (2, "model", "C")]
    jobs.edit(store, spark.createDataFrame(edits, "id long, key string, value string").coalesce(1))
    assert {r.id: r.model for r in store.read("staged", staged_schema()).collect()} == {1: "B8", 2: "C"}
    learned = {r.raw_pattern: (r.target_value, r.ord) for r in store.read("rules", jobs.RULES).collect()}
    assert learned["A"][0] == "last" and learned["B6"][0] == "B7" and learned[""][0] == "C" and "last" not in learned
    assert len({o for _, o in learned.values()}) == len(learned) and max(o for _, o in learned.values()) < 20
    assert not re.search("1[0-9]{6,}", str(learned))


def test_changes_merged_at_read(spark, tmp_path):
    """Random edits and deletes over base and deltas, with a compaction in between, against the same edits on a list."""
    rng = random.Random(6)
    schema = "id long, a string, n long, status string"
    rows = {i: {"a": f"a{i}", "n": i, "status": "pending"} for i in range(1, 40)}
    store = jobs.Store(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(i, *r.values()) for i, r in rows.items()], schema))
    for step in range(7):
        if step in (2, 5):
            gone = rng.sample(range(1, 45), 5)
            store.change("t", schema, lambda n, gone=gone: deltas.drop_changes(spark.createDataFrame([(i,) for i in [*gone, None]], "id long"), n), most=4)
            rows = {i: r for i, r in rows.items() if i not in gone}
        else:
            edits = [(rng.randrange(1, 45), k, v, o) for o, (k, v) in enumerate(rng.choices([("a", "x"), ("a", None), ("n", "7"), ("n", "many"), ("status", "synced"), ("nope", "y")], k=60))]
            store.change("t", schema, lambda n, edits=edits: deltas.edit_changes(spark.createDataFrame(edits, "id long, key string, value string, ord int"), n), most=4)
            for i, k, v, _ in edits:
                if i in rows and k in rows[i]:
                    rows[i][k] = v if k != "n" or v is None else int(v) if v.isdigit() else None
        if step == 3:
            store.append("t", spark.createDataFrame([(100, "late", 1, "pending")], schema))
            rows[100] = {"a": "late", "n": 1, "status": "pending"}
    assert {r.id: {"a": r.a, "n": r.n, "status": r.status} for r in store.read("t", schema).collect()} == rows
    assert max(v for v, _ in store._parts("t")) > 1
    store.change("missing", schema, lambda n: deltas.drop_changes(spark.createDataFrame([(1,)], "id long"), n))
    assert store.read("missing", schema).count() == 0


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = jobs.Store(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(0,)], "id long"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.append("t", spark.range(100 * i, 100 * i + 10)), range(1, 7)))
    assert store.read("t", "id long").distinct().count() == 61
    assert len({k for _, k in store._parts("t")}) == 7


def test_a_token_is_added_once(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    for n in (3, 5):
        store.append("t", spark.range(n), "batch-0")
    assert store.read("t", "id long").count() == 3
    version, number = store._token("t", "batch-0")
    (tmp_path / "t" / f"v={version}" / f"add={number}" / "_SUCCESS").unlink()  # as if the writer had been lost on the way
    store.append("t", spark.range(10, 15), "batch-0")
    store.append("t", spark.range(20, 22), "batch-1")
    assert sorted(r.id for r in store.read("t", "id long").collect()) == [10, 11, 12, 13, 14, 20, 21]
    store.replace("t", store.read("t", "id long"))
    store.append("t", spark.range(10, 15), "batch-0")
    assert store.read("t", "id long").count() == 7
