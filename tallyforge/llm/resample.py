"""Importance resampling towards a target distribution: documents are weighed by hashed word runs, and the highest weighed
draws are selected exactly."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import with_ids
from .decontaminate import bench_words
from .shared import drop_staged, each_text, fresh, staged

BUCKETS = 10_000
#: Longest run of words that is a feature.
RUN = 2
MIN_WORDS, PERCENT, SEED = 20, 25, "7"
#: Bytes of a text whose words are held at once.
SLICE_BYTES = 1 << 20
#: Keys (four integers each) that the selection brings to the driver when so few are left.
FEW = 10_000
#: The selection writes the keys that are left anew whenever they have shrunk by so much.
SHRINK = 8
KEY = ("k0", "k1", "k2", "k3")
_TOP = (1 << 63) - 1


def feature_buckets(text: bytes, buckets: int = BUCKETS, run: int = RUN):
    """For each slice of a text, (words, buckets of all runs of 1 to ``run`` words that end in it). A run's bucket is the
    CRC-32 of its words with single spaces, modulo ``buckets``; the sum of a run goes on from that of the run before its last
    word. Slices end at spaces, and the last words of one are carried to the next."""
    lo, carried = 0, []
    while lo < len(text):
        hi = text.find(b" ", lo + SLICE_BYTES)
        hi = len(text) if hi < 0 else hi
        words = bench_words(text[lo:hi])
        c, words = len(carried), carried + words
        spaced = [b" " + w for w in words[1:]]
        sums = list(map(crc32, words))
        found = [sums[c:]]
        for k in range(2, run + 1):
            sums = list(map(crc32, spaced[k - 2 :], sums))  # the run of k words that begins at each place
            found.append(sums[max(0, c - k + 1) :])
        yield len(words) - c, np.fromiter((x for f in found for x in f), np.uint32, sum(map(len, found))) % np.uint32(buckets)
        carried = words[len(words) - min(len(words), run - 1) :]
        lo = hi


def bucket_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row for each bucket it has met, whatever the
    number of its texts, and what reaches the driver is one number a bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in each_text(batch.column(0)):
                for _, found in feature_buckets(text, buckets, run):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    rows = texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets, in doubles."""
    b = float(len(raw))
    raw, target = raw.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((target + 1) * (raw.sum() + b) / ((raw + 1) * (target.sum() + b)))).astype(np.int64)


def weigher(gain: np.ndarray, run: int = RUN):
    """Column function: text to struct (n_words, n_features, weight), the weight being the floored mean gain of the features."""

    def weigh(texts: pa.Array) -> pa.Array:
        words, features, weights = [], [], []
        for text in each_text(texts):
            w = n = total = 0
            for k, found in feature_buckets(text, len(gain), run):
                w, n, total = w + k, n + len(found), total + int(gain[found].sum())
            words.append(w)
            features.append(n)
            weights.append(total // n if n else 0)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (words, features, weights)], ["n_words", "n_features", "weight"])

    return F.arrow_udf(weigh, "struct<n_words:long,n_features:long,weight:long>")


def gumbel(id_: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h being the first 32 bits of the SHA-256 of seed, colon and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _below(keys: list[np.ndarray], than: tuple[int, ...]) -> np.ndarray:
    """Which keys come before one of them."""
    out, same = np.zeros(len(keys[0]), bool), np.ones(len(keys[0]), bool)
    for column, x in zip(keys, than):
        out |= same & (column < x)
        same &= column == x
    return out


def _median(keys: list[np.ndarray]) -> tuple[int, ...]:
    """The middle key of some (the lower one of two)."""
    at = np.lexsort(keys[::-1])[(len(keys[0]) - 1) // 2]
    return tuple(int(k[at]) for k in keys)


def weighted_median(medians: list[tuple[int, tuple[int, ...]]]) -> tuple[int, ...]:
    """The median of (weight, key) by weight: at least half of the weight is at or below it, and at least half at or above."""
    half, upto = sum(w for w, _ in medians), 0
    for weight, key in sorted(medians, key=lambda m: m[1]):
        upto += weight
        if 2 * upto >= half:
            return key
    raise ValueError("no medians")


def _halves(keys: DataFrame, low, pivot, high) -> list[tuple[int, int, tuple[int, ...]]]:
    """(side, number, median) of what a partition has strictly between ``low`` and ``pivot`` (side 0) and between ``pivot``
    and ``high`` (side 1); without a pivot, all is on side 1. A batch gives its own median, and the partition's is that of its
    batches by weight, so a task holds one batch."""

    def run(batches):
        found: tuple[list, list] = ([], [])
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(len(KEY))]
            inside = np.ones(len(columns[0]), bool)
            if low is not None:
                inside &= ~_below(columns, low) & ~_same(columns, low)
            if high is not None:
                inside &= _below(columns, high)
            columns = [k[inside] for k in columns]
            under = _below(columns, pivot) if pivot is not None else np.zeros(len(columns[0]), bool)
            over = ~under & ~_same(columns, pivot) if pivot is not None else ~under
            for side, mask in enumerate((under, over)):
                if mask.any():
                    part = [k[mask] for k in columns]
                    found[side].append((len(part[0]), _median(part)))
        rows = [(side, sum(w for w, _ in f), *weighted_median(f)) for side, f in enumerate(found) if f]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 6)], ["side", "n", *KEY])

    got = keys.mapInArrow(run, "side long, n long, " + ", ".join(f"{k} long" for k in KEY)).collect()
    return [(r.side, r.n, tuple(r[k] for k in KEY)) for r in got]


def _same(keys: list[np.ndarray], as_: tuple[int, ...]) -> np.ndarray:
    out = np.ones(len(keys[0]), bool)
    for column, x in zip(keys, as_):
        out &= column == x
    return out


def _between(low, high) -> Column:
    """The same as a condition: strictly between two keys."""
    key, at = F.struct(*KEY), lambda k: F.struct(*[F.lit(x).cast("long").alias(c) for x, c in zip(k, KEY)])
    return (key > at(low) if low is not None else F.lit(True)) & (key < at(high) if high is not None else F.lit(True))


def cutoff(keys: DataFrame, k: int, few: int = FEW) -> tuple[int, ...] | None:
    """The ``k``-th smallest of distinct keys (k0 to k3), exactly; null if there are fewer.

    Weighted median of medians: each partition gives the median of the keys that it has left and their number, the median of
    those by weight is the next pivot, and the partitions count on both sides of it. The half that can't hold the key goes (at
    least an eighth of what is left, two levels of medians being at work), until ``few`` keys or the key itself are left. The
    driver sees one row for each side of a partition. What is left is written anew when it has shrunk by ``SHRINK``.
    """
    low = high = None
    before, own, medians = 0, False, _halves(keys, None, None, None)
    left = written = sum(n for _, n, _ in medians)
    if not 1 <= k <= left:
        return None
    while left > few:
        pivot = weighted_median([(n, m) for _, n, m in medians])
        halves = _halves(keys, low, pivot, high)
        under = sum(n for side, n, _ in halves if side == 0)
        if k == before + under + 1:
            break
        side = 0 if k <= before + under else 1
        if side == 0:
            high = pivot
        else:
            low, before = pivot, before + under + 1
        medians = [h for h in halves if h[0] == side]
        left = sum(n for _, n, _ in medians)
        if left * SHRINK < written and left > few:
            smaller = staged(keys.where(_between(low, high)), "resample-left")
            if own:
                drop_staged(keys)
            keys, own, written = smaller, True, left
    else:
        rest = sorted(tuple(r) for r in keys.where(_between(low, high)).select(*KEY).collect())  # at most ``few``
        pivot = rest[k - before - 1]
    if own:
        drop_staged(keys)
    return pivot


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", keep: tuple[str, ...] = (),
    percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, run: int = RUN, seed: str = SEED,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank, *keep) of every row of ``docs``.

    Of the rows with ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn: those of the highest scores,
    which are weights plus seeded Gumbel noise, so that they are a draw without replacement by weight. ``rank`` counts them in
    that order from 1; it is null for the others.

    A null text has no words; empty texts weigh 0 and are never drawn while ``min_words`` is above 0. Texts are read whole, in
    slices. Ties of scores go to the smaller id (a null id, and ids that aren't integers, by a hash, come last), then by a
    hash of the text; rows equal in all of that are dealt out one by one, so the number drawn is exact. An empty table gives
    none; an empty target gives every bucket the same smoothed share. Other columns of ``docs`` are not read, but for
    ``keep``, whose names may not be those of the results.
    """
    results = ["id", "n_words", "n_features", "weight", "score", "rank"]
    if clash := [c for c in keep if c in results]:
        raise ValueError(f"kept columns named like results: {clash}")
    gain = gains(bucket_counts(docs, text_col, buckets, run), bucket_counts(target, target_text, buckets, run))
    is_whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    (w,) = fresh(docs, "w")
    weighed = docs.select(id_.alias("id"), *[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)], F.xxhash64(text).alias("k2"), weigher(gain, run)(text).alias(w))
    score = F.col(w)["weight"] + gumbel(F.col("id"), seed)
    order = F.col("id").cast("long") if is_whole else F.bitwise_not(F.xxhash64("id"))
    rows = weighed.select(
        "id", *[f"keep_{i}" for i in range(len(keep))], *[F.col(w)[c].alias(c) for c in ("n_words", "n_features", "weight")], score.alias("score"),
        (-score).alias("k0"), F.coalesce(order, F.lit(_TOP)).alias("k1"), "k2", F.monotonically_increasing_id().alias("k3"),
    )
    rows = staged(rows, "resample-rows")
    able = F.col("n_words") >= min_words
    keys = rows.where(able).select(*KEY)
    k = percent * keys.count() // 100
    last = cutoff(keys, k)
    taken = F.lit(False) if last is None else able & ~_between(last, None)
    columns = [c for c in rows.columns if c not in KEY]
    winners = with_ids(rows.where(taken).withColumnRenamed("id", "of"), 0, list(KEY)).withColumnRenamed("id", "rank").withColumnRenamed("of", "id") if last is not None else rows.limit(0).withColumn("rank", F.lit(None).cast("long"))
    out = winners.select(*columns, "rank").unionByName(rows.where(~taken).select(*columns, F.lit(None).cast("long").alias("rank")))
    return out.select(*results, *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)])


SQL = f"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS s FROM crc WHERE k = 8),
words AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
runs AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
texts AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM runs),
hashed AS (
  SELECT f, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, s[xor(a & 255, b) + 1])), 4294967295) % {BUCKETS})::BIGINT AS bucket FROM texts, steps),
found AS (SELECT side, r, bucket FROM runs JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM found GROUP BY bucket),
totals AS (SELECT count(*) FILTER (side = 0)::DOUBLE AS s_all, count(*) FILTER (side = 1)::DOUBLE AS t_all FROM found),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS g FROM counts, totals),
per AS (SELECT r, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM found JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
d AS (
  SELECT doc_id, r, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM words LEFT JOIN per USING (r) WHERE side = 0),
o AS (
  SELECT *, weight + noise AS score, n_words >= {MIN_WORDS} AS able, CASE WHEN n_words >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY weight + noise DESC, doc_id NULLS LAST) END AS place,
    count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS n FROM d)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank FROM o
"""
