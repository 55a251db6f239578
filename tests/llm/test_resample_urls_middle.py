"""Importance resampling, URL filters and fill-in-the-middle against brute force, round trips and odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import fim, resample, urls

DOCS = "doc_id long, text string, source string"
ODD = [None, "", " \n\t", "one", "ÄÖ ü\u3000x", "a\x00b", "日本語 のテキスト\u3000です " * 9, "mixed é 🎉 text\twith\r\nmany  kinds ", "word " * 4000, "\n\nlead", "<P> marked", "trailing <", "< S>"]


def odd_rows(extra=200):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("w%d" % rng.randrange(60), "Zoë", "naïve", "x-y_z", "日本")) for _ in range(rng.randrange(1, 60))) for _ in range(extra)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate([*ODD, *texts])]
    return [*rows, rows[5], rows[30], rows[30], rows[30], (None, "no id", None), (None, texts[7], "s")]


# ------------------------------------------------------------------ fill in the middle


def cut_by_characters(doc_id, text, unit="token", rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text) if unit == "token" else list(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit, rate, spm, held", [("token", 50, 80, 8 << 20), ("token", 100, 50, 64), ("char", 100, 50, 1000)])
def test_middle_by_brute_force(spark, monkeypatch, unit, rate, spm, held):
    monkeypatch.setattr(fim, "OUTPUT_BYTES", held)
    rows = odd_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    plan = fim.Plan(unit=unit, rate=rate, suffix_first=spm)
    out = fim.transform(docs, plan=plan).withColumn("back", fim.restore(F.col("output"), F.col("form"), plan)).collect()
    got = Counter((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out)
    assert got == Counter((i, t, *cut_by_characters(i, t, unit, rate, spm)) for i, t, _ in rows)
    assert all(r.back == (r.text or "") for r in out)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_exception_index_converts_both_ways():
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice("ab é日🎉\n") for _ in range(rng.randrange(40)))
        index = fim.ExceptionIndex(text.encode())
        at = np.arange(len(text) + 1)
        in_bytes = np.array([len(text[:i].encode()) for i in at])
        assert (index.bytes(at) == in_bytes).all() and (index.chars(in_bytes) == at).all()
    assert not len(fim.ExceptionIndex(b"plain").at_byte)


def test_middle_odd_tables(spark):
    assert fim.transform(spark.createDataFrame([], DOCS)).count() == 0
    clash = spark.createDataFrame([(1, "a b c", "x", "y", 5, "z")], "doc_id long, text string, output string, cut string, n int, `a.b` string")
    row = fim.transform(clash, plan=fim.Plan(rate=100)).first()
    assert row["a.b"] == "z" and row["cut"] == "y" and row["n"] == 3 and row["output"] != "x"
    for bad in ({"unit": "line"}, {"prefix": ""}, {"prefix": "<S"}, {"prefix": "aba"}, {"prefix": "<S>"}):
        with pytest.raises(ValueError):
            fim.Plan(**bad)


# ------------------------------------------------------------------ importance resampling


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def runs_of(words, run):
    return [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]


def weigh_by_hand(rows, target, run=2, buckets=10_000, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [[bucket(f) for f in runs_of(words_of(t), run)] for _, t in rows]
    s, t = Counter(b for f in found for b in f), Counter(bucket(f) for x in target for f in runs_of(words_of(x), run))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for (i, text), f in zip(rows, found):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words_of(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("run, buckets, percent, few, size", [(2, 10_000, 25, 10_000, 1 << 20), (2, 10_000, 60, 3, 40), (3, 50, 100, 5, 64), (1, 10_000, 0, 4, 1 << 20)])
def test_resampling_by_brute_force(spark, monkeypatch, run, buckets, percent, few, size):
    monkeypatch.setattr(resample, "SLICE_BYTES", size)
    monkeypatch.setattr(resample, "cutoff", lambda keys, k, f=resample.cutoff: f(keys, k, few))
    rows = [(i, t) for i, t, _ in odd_rows()]
    target = [t for _, t in rows[40:60]] + ["w1 w2 w3 " * 20, None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = resample.importance_resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), run=run, buckets=buckets, percent=percent).collect()
    want, drawn = weigh_by_hand(rows, target, run, buckets, percent)
    assert Counter((r.id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(map(tuple, want))
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.id, r.score) for r in ranked] == [(x[0], x[4]) for x in drawn]


def test_cutoff_is_exact(spark):
    rng = random.Random(2)
    keys = [(rng.randrange(5), rng.randrange(4), rng.randrange(-3, 3), i) for i in range(700)]
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, k3 long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for k in (1, 2, 350, 699, 700):
            assert resample.cutoff(df, k, few=2) == sorted(keys)[k - 1]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert resample.cutoff(df, 0) is None and resample.cutoff(df, 701) is None and resample.cutoff(df.limit(0), 1) is None


def test_resampling_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    target = spark.createDataFrame([(1, text)], "item_id long, text string")
    same = spark.createDataFrame([(7, text, "k")] * 9 + [(8, "short", "m")], "doc_id long, text string, `a.b` string")  # equal rows: as many as are due
    got = resample.importance_resample(same, target, keep=("a.b",)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2] and {r["a.b"] for r in got} == {"k", "m"}
    assert resample.importance_resample(same.limit(0), target).count() == 0
    assert resample.importance_resample(same, target.limit(0)).count() == 10
    named = spark.createDataFrame([("b", text), ("a", text), (None, text), ("c", text)], "doc_id string, text string")
    assert sorted(r["rank"] for r in resample.importance_resample(named, target, percent=50).where("rank > 0").collect()) == [1, 2]
    with pytest.raises(ValueError):
        resample.importance_resample(same.withColumn("rank", F.lit(1)), target, keep=("rank",))


# ------------------------------------------------------------------ URL filters


URLS = [
    "http://www.Example.com/en/a", "https://example.com/en/x?y=1", "http://blog.example.com/en", "http://a.net/es/1", "https://x.a.net/fr/2#t", "http://net/es/", "HTTP://a.org/en/é/long?q=1&r&=2", "http://com/", "http://com", "http://notcom/",
    "http://u@example.com:80/en/", "no scheme", "", None, "://", ":///p", "http://?q", "http://a..net/es/", "ftp://EXAMPLE.COM/en/", "x://a.net/es", "a://b://c.net/fr/", "http://a.net\n/es/", "http://example.com/EN/", "http://www.example.com/en/",
]


def judge(url, policy=urls.POLICY):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    best = None
    for rule in policy:
        said, pattern = rule.split(" ")
        on, _, below = pattern.partition("/")
        if (host == on or host.endswith("." + on)) and path.startswith("/" + below):
            best = max(best or (0,), (len(pattern), len(on), said == "allow", pattern, said))
    return host, path, best and best[3], best and best[4]


def test_policy_by_brute_force(spark):
    policy = [*urls.POLICY, "block a.net/es/", "allow net/es/1", "block org/en/", "allow b.c.d.example.com/"]
    for rules in (urls.POLICY, policy, []):
        rows = spark.createDataFrame([(u,) for u in URLS], "url string").withColumn("host", urls.host_of(F.col("url"))).withColumn("path", urls.path_of(F.col("url")))
        got = [tuple(r) for r in urls.by_policy(rows, rules, "host", "path", "rule", "verdict").select("url", "host", "path", "rule", "verdict").collect()]
        assert Counter(got) == Counter((u, *judge(u, rules)) for u in URLS)
    for bad in ("deny com/", "allow /x"):
        with pytest.raises(ValueError):
            urls.by_policy(rows, [bad], "host", "path", "rule", "verdict")


def rules_by_hand(sets, least_rows, sure):
    """Every combination with enough rows and confidence, and none that a part of it says as surely."""
    held, both = Counter(), Counter()
    for tokens, label in sets:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                held[c] += 1
                both[c, label] += 1
    good = {(c, label): n / held[c] for (c, label), n in both.items() if n >= least_rows and n / held[c] >= sure}
    return {(c, label): p for (c, label), p in good.items() if not any(good.get((part, label), 0) >= p for k in range(1, len(c)) for part in combinations(c, k))}


def test_mined_rules_by_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        host, lang, kind = rng.choice(("a.com", "b.com", "c.org", "win.org")), rng.choice(("en", "fr", "es")), rng.choice(("news", "casino", "shop"))
        bad = (kind == "casino" and host != "c.org") or (lang == "es" and kind == "shop")
        label = "block" if bad != (rng.random() < 0.05) else "allow"
        rows.append((f"http://{host}/{lang}/{kind}/{i}", label))
    mined = urls.mine(spark.createDataFrame(rows, "url string, label string").repartition(3), 0.02, 0.7)
    words = set(urls._vocabulary(urls.staged(spark.createDataFrame(rows, "url string, label string").select(urls.tokens_of(F.col("url")).alias("tokens"), "label").groupBy("tokens", "label").agg(F.count("*").alias("n")), "t"), 400, sum(x == "block" for _, x in rows), 0.02))
    tokens = {r.url: set(r.t) & words for r in spark.createDataFrame(rows, "url string, label string").select("url", urls.tokens_of(F.col("url")).alias("t")).collect()}
    want = rules_by_hand([(tokens[u], label) for u, label in rows], max(10, 8), 0.7)
    got = {(tuple(r.tokens), r.verdict): r.confidence for r in mined.table.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - p) < 1e-9 for k, p in want.items())
    fresh_urls = spark.createDataFrame([(f"http://{h}/{x}/{k}/9", "extra") for h in ("a.com", "c.org", "new.org") for x in ("en", "es") for k in ("news", "casino", "shop")] + [(None, "e"), ("", "e")], "url string, tokens string")
    out = urls.by_rules(fresh_urls, mined, "url", "verdict").collect()
    found = {r.url: set(r.t or ()) for r in fresh_urls.select("url", urls.tokens_of(F.col("url")).alias("t")).collect()}
    support = {(tuple(r.tokens), r.verdict): r.support for r in mined.table.collect()}
    for r in out:
        fit = [(p, support[c, label], label) for (c, label), p in got.items() if set(c) <= found[r.url]]
        assert r.verdict == (max(fit)[2] if fit else mined.otherwise) and r.tokens.startswith("e")
    verdicts = {r.url: r.verdict for r in out}
    assert verdicts["http://a.com/en/casino/9"] == "block" and verdicts["http://c.org/en/casino/9"] == "allow" and verdicts["http://new.org/es/shop/9"] == "block"


def test_tokens_on_the_same_rows_are_one(spark):
    """A third of all rows is one long URL: its combinations don't multiply."""
    hot = "http://hot.example/" + "/".join(f"seg{chr(97 + i)}" for i in range(24))
    rows = [(hot, "block")] * 200 + [(f"http://s{i % 7}.com/p/{i}", "allow") for i in range(400)]
    mined = urls.mine(spark.createDataFrame(rows, "url string, label string"))
    assert mined.table.count() < 20 and mined.otherwise == "allow"
    assert urls.by_rules(spark.createDataFrame([(hot,)], "url string"), mined, "url", "v").first().v == "block"


def test_rules_with_tokens_far_back_in_long_rows(spark):
    """Rows of up to 15 tokens that no two of which go together: every combination is mined, whatever its tokens' places."""
    rng = random.Random(11)
    rows = []
    for _ in range(150):
        ks = [k for k in range(15) if rng.random() < 0.85]
        bad = {1, 4, 8} <= set(ks) or not {2, 3} & set(ks)
        rows.append(("?" + "&".join(f"k{k:02d}" for k in ks), "block" if bad != (rng.random() < 0.1) else "allow"))
    tokens = [{f"query {x}" for x in u[1:].split("&") if x} for u, _ in rows]
    assert sum(len(t) > urls.MOST_TOKENS for t in tokens) > 50
    want = rules_by_hand([(t, label) for t, (_, label) in zip(tokens, rows)], 10, 0.6)
    mined = urls.mine(spark.createDataFrame(rows, "url string, label string").repartition(3))
    got = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in mined.table.collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] - p) < 1e-9 for k, p in want.items())
    held = {c: sum(set(c[0]) <= t and label == c[1] for t, (_, label) in zip(tokens, rows)) for c in got}
    assert all(abs(got[c][1] - n / len(rows)) < 1e-9 for c, n in held.items())
    assert len({t for c, _ in got for t in c}) == 15


def test_tokens_of_a_long_row_that_stand_elsewhere_too(spark):
    """A row of thirty tokens, each of which has other rows of its own: 2 ** 30 combinations, of which the pairs say it all."""
    hot = "?" + "&".join(f"k{k:02d}" for k in range(30))
    rows = [(hot, "block")] * 200 + [(f"?k{k:02d}&z{i}", "allow") for k in range(30) for i in range(12 + k)]
    mined = urls.mine(spark.createDataFrame(rows, "url string, label string"))
    got = {tuple(r.tokens): (r.verdict, round(r.confidence, 9)) for r in mined.table.collect()}
    names = [f"query k{k:02d}" for k in range(30)]
    want = {(a,): ("block", round(200 / (212 + k), 9)) for k, a in enumerate(names)} | {(a, b): ("block", 1.0) for i, a in enumerate(names) for b in names[i + 1 :]}
    assert {c: v for c, v in got.items() if all(t in names for t in c)} == want
    out = urls.by_rules(spark.createDataFrame([(f"?k28&k29",), ("?k29",), ("?zz",)], "url string"), mined, "url", "v").collect()
    assert [r.v for r in out] == ["block", "block", "allow"]


def test_url_odd_tables(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://a.org/", "h"), (3, URLS[3], "h")], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(11, "block"), (11, "allow"), (None, "block"), (0, None), (6, "junk")], "id long, label string")
    got = urls.filter_urls(pages, labels).collect()
    assert Counter((r.id, r.host, r.path, r.rule) for r in got) == Counter((r.page_id, *judge(r.url)[:3]) for r in pages.collect())
    assert all(r.verdict == (judge(URLS[r.id])[3] if r.id is not None else None) or (r.rule is None and r.verdict in ("allow", "block")) for r in got)
    assert urls.filter_urls(pages.limit(0), labels).count() == 0
    empty = urls.mine(spark.createDataFrame([], "url string, label string"))
    assert empty.otherwise == "allow" and empty.table.count() == 0
    long = spark.createDataFrame([("http://h.com/" + "x" * 200_000 + "/y?" + "k=1&" * 5000,)], "url string")
    assert max(map(len, long.select(urls.tokens_of(F.col("url"))).first()[0])) <= urls.TOKEN_CHARS
    assert defaultdict(int, urls.filter_urls(long.withColumn("page_id", F.lit(1)), labels).first().asDict())["rule"] == "com/"
