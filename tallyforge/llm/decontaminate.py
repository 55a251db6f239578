"""Benchmark decontamination by suffix arrays over the training words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, drop_staged, each_text, fresh, staged, text_bytes

WINDOW = 10
#: Words of passages that one suffix array covers.
SHARD_WORDS = 1_500_000
#: Bytes of benchmark text that one pass holds in each task; a larger benchmark takes several passes, one after the other.
PASS_BYTES = 4 << 20
#: Words of one piece of an item; longer items are cut into pieces that overlap by a window less a word.
PIECE_WORDS = 50_000
#: Bits of the filter: at least so many for each word of the benchmark, and at most 2 ** MAX_SLOT_BITS (32 MB) in all.
SLOTS_PER_WORD, MAX_SLOT_BITS, PROBES = 64, 28, 3
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _SEPARATORS and not 0x41 <= b <= 0x5A else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
MATCH = "array<struct<start:long,length:long,item:string>>"


def bench_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_TABLE).split()


def count_words(text: Column) -> Column:
    """How many words ``bench_words`` finds; 0 for null. (A count by a pattern in the engine takes five times as long.)"""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([len(bench_words(t)) for t in each_text(texts)], pa.int64())

    return F.arrow_udf(run, "long")(text)


class Filter:
    """``PROBES`` bits for each hash of a window (its words, and how many): says which words of a text can lie in a match."""

    def __init__(self, words: int, window: int):
        self.window = window
        self.slot_bits = int(np.clip(int(max(1, words) * SLOTS_PER_WORD).bit_length(), 16, MAX_SLOT_BITS))
        self.bits = np.zeros(1 << (self.slot_bits - 3), np.uint8)
        self.lengths: set[int] = set()

    def _hashes(self, words: list[bytes]):
        """For each number of words in use, the hashes of all runs of so many words."""
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        total, factor = np.zeros(len(h), np.uint64), 1
        for n in range(1, min(self.window, len(h)) + 1):
            total = total[: len(h) - n + 1] + h[n - 1 :] * np.uint64(factor)
            factor = factor * _STEP % (1 << 64)
            if n in self.lengths:
                x = (total ^ (total >> np.uint64(29)) ^ np.uint64(n)) * _MIX
                yield n, (x ^ (x >> np.uint64(32))) * _MIX

    def _probes(self, x: np.ndarray, probes: int = PROBES):
        for _ in range(probes):
            slot = (x >> np.uint64(64 - self.slot_bits)).astype(np.int64)
            yield slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8)
            x = (x ^ (x >> np.uint64(29))) * _MIX

    def add(self, words: list[bytes]) -> None:
        if words:
            self.lengths.add(min(len(words), self.window))
            for n, x in self._hashes(words):
                if n == min(len(words), self.window):
                    for byte, bit in self._probes(x):
                        np.bitwise_or.at(self.bits, byte, bit)

    def passages(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, behind the last word) of the runs that every possible match lies within."""
        inside = np.zeros(len(words) + 1, np.int64)
        for n, x in self._hashes(words):
            at = np.arange(len(x))
            for k in range(PROBES):  # later probes look at what the earlier ones left
                byte, bit = list(self._probes(x[at], k + 1))[k]
                at = at[(self.bits[byte] & bit) != 0]
            np.add.at(inside, at, 1)
            np.add.at(inside, at + n, -1)
        on = np.diff(np.concatenate([[0], (np.cumsum(inside)[:-1] > 0).astype(np.int8), [0]]))
        return list(zip(np.flatnonzero(on == 1).tolist(), np.flatnonzero(on == -1).tolist()))


class TestSuffixes:
    """Word ids and packed first words of every suffix of one part of the benchmark that is a window or more."""

    __test__ = False

    def __init__(self, pieces: list[tuple[str | None, bytes]], window: int):
        self.items: list[str | None] = [i for i, _ in pieces]
        words = [ws.split() for _, ws in pieces]
        self.ids: dict[bytes, int] = {}
        coded = [np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in ws], np.int64) for ws in words]
        self.window, self.depth = window, max(map(len, words), default=1)
        self.bits = max(1, int(len(self.ids) + 1).bit_length())
        self.per_key = 63 // self.bits
        self.keys = -(-window // self.per_key)
        n = np.array([max(1, len(c) - window + 1) for c in coded], np.int64)
        self.piece = np.repeat(np.arange(len(coded)), n)
        self.length = np.array([min(len(c), window) for c in coded], np.int64)[self.piece]
        padded = np.zeros((int(n.sum()), window), np.int64)
        row = 0
        for c, m in zip(coded, n.tolist()):
            k = min(len(c), window)
            padded[row : row + m, :k] = np.lib.stride_tricks.sliding_window_view(c, k)
            row += m
        self.low = self.pack(padded)
        self.high = self.pack(np.where(np.arange(window) < self.length[:, None], padded, (1 << self.bits) - 1))

    def pack(self, words: np.ndarray) -> np.ndarray:
        """Word ids of each row in a few integers that compare as the rows do; missing words are 0."""
        out = np.zeros((self.keys, len(words)), np.int64)
        for k in range(self.keys):
            for j in range(self.per_key):
                c = k * self.per_key + j
                out[k] = (out[k] << self.bits) | (words[:, c] if c < self.window else 0)
        return out


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the suffixes that begin there, by their first ``depth`` words at least (prefix doubling)."""
    n, k = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    while k < depth:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])[:n]
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            break
        k *= 2
    return order


def _search(sorted_keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of every wanted row among sorted rows at once; after: behind equal rows, not before."""
    lo, hi = np.zeros(wanted.shape[1], np.int64), np.full(wanted.shape[1], sorted_keys.shape[1])
    while (lo < hi).any():
        mid = (lo + hi) // 2
        at = np.minimum(mid, sorted_keys.shape[1] - 1)
        less, equal = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for k in range(len(wanted)):
            x, y = sorted_keys[k][at], wanted[k]
            less |= equal & (x < y)
            equal &= x == y
        right = (less | (equal & after)) & (lo < hi)
        lo, hi = np.where(right, mid + 1, lo), np.where(right | (lo >= hi), hi, mid)
    return lo


def shard_matches(passages: list[np.ndarray], tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(passage, start, length, piece) of the longest runs of words that a passage shares with a piece of the benchmark.

    Every test suffix is searched in the shard's suffix array: the training suffixes that begin with its first words lie
    side by side there. Neighbouring suffixes that match on the same diagonal are one longer match.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    sizes, gap = np.array([len(p) for p in passages], np.int64), tests.window
    if not len(sizes) or not len(tests.length):
        return none
    first = np.concatenate([[0], np.cumsum(sizes + gap)])[:-1]
    ids = np.zeros(int((sizes + gap).sum()) + gap, np.int64)
    for p, f in zip(passages, first):
        ids[f : f + len(p)] = p
    suffixes = suffix_array(ids, min(tests.depth, int(sizes.max())))
    suffixes = suffixes[ids[suffixes] != 0]
    if not len(suffixes):
        return none
    keys = tests.pack(np.lib.stride_tricks.sliding_window_view(ids, gap)[suffixes])
    lo, hi = _search(keys, tests.low, False), _search(keys, tests.high, True)
    n = (hi - lo).clip(0)
    if not n.sum():
        return none
    test = np.repeat(np.arange(len(n)), n)
    pos = suffixes[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    piece, length = tests.piece[test], tests.length[test]
    own = np.searchsorted(first, pos, side="right") - 1
    diagonal = pos - test
    order = np.lexsort((pos, diagonal, piece))
    own, pos, piece, length, diagonal = (x[order] for x in (own, pos, piece, length, diagonal))
    new = np.ones(len(pos), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (diagonal[1:] != diagonal[:-1]) | (pos[1:] != pos[:-1] + 1) | (own[1:] != own[:-1])
    heads = np.flatnonzero(new)
    run = np.diff(np.append(heads, len(pos)))
    return own[heads], pos[heads] - first[own[heads]], length[heads] + run - 1, piece[heads]


def _pieces(benchmark: DataFrame, item_col: str, item_text: str, window: int, piece_words: int) -> DataFrame:
    """(item, words, n): the different items as blank-separated words, long ones in overlapping pieces."""

    def run(batches):
        for batch in batches:
            for i, text in enumerate(text_bytes(batch.column(1))):
                words = bench_words(text)
                cuts = range(0, max(1, len(words) - window + 1), piece_words)
                parts = [words[c : c + piece_words + window - 1] for c in cuts if words]
                item = batch.column(0).slice(i, 1)
                if parts:
                    items = pa.concat_arrays([item] * len(parts))
                    yield pa.RecordBatch.from_arrays([items, pa.array([b" ".join(p) for p in parts]), pa.array([len(p) for p in parts], pa.int64())], ["item", "words", "n"])

    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).where("text is not null").distinct()
    return items.mapInArrow(run, "item string, words binary, n long")


def _found_passages(shared):
    def run(batches):
        test = shared.value
        for batch in batches:
            rows: tuple[list, list, list] = [], [], []
            for i, text in enumerate(each_text(batch.column(2))):
                words = bench_words(text)
                for a, b in test.passages(words):
                    for column, x in zip(rows, (i, a, b" ".join(words[a:b]))):
                        column.append(x)
            at = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], ["h1", "h2", "start", "words"])

    return run


def _matched(shared, shard_words: int):
    def run(batches):
        tests = shared.value
        for batch in batches:
            coded, where, held = [], [], 0

            def flush(where, coded):
                own, start, length, piece = shard_matches(coded, tests)
                row = np.array(where, np.int64)[own] if len(own) else own
                at = pa.array(row, pa.int64())
                begin = batch.column(2).to_numpy()[row] if len(row) else row
                items = pa.array([tests.items[p] for p in piece.tolist()], pa.string())
                return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(begin + start, pa.int64()), pa.array(length, pa.int64()), items], ["h1", "h2", "start", "length", "item"])

            for i, words in enumerate(x.split() for x in batch.column(3).to_pylist()):
                coded.append(np.fromiter(map(tests.ids.get, words, [0] * len(words)), np.int64, len(words)))
                where.append(i)
                held += len(words)
                if held >= shard_words:
                    yield flush(where, coded)
                    coded, where, held = [], [], 0
            if coded:
                yield flush(where, coded)

    return run


def content_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, pass_bytes: int = PASS_BYTES, piece_words: int = PIECE_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(h1, h2, matches) of every text (by content key) that shares words with the benchmark.

    Documents are read once: a filter of bounded size over all windows picks the passages that can match, and equal
    passages of equal texts are folded. The passages are the training side of the suffix arrays. The benchmark is cut into
    parts of about ``pass_bytes``; each pass broadcasts one part's suffixes, writes its matches and lets the part go, so
    neither the driver nor a task holds more than a part, however large the benchmark is.
    """
    spark = docs.sparkSession
    pieces = staged(_pieces(benchmark, item_col, item_text, window, piece_words), "benchmark")
    bytes_, words = pieces.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    passes = max(1, -(-int(bytes_) // pass_bytes))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(passes))
    test = Filter(int(words), window)
    for k in range(passes):
        for row in pieces.where(part == k).select("words").collect():
            test.add(bytes(row.words).split())
    shared = spark.sparkContext.broadcast(test)
    source = docs.where(F.length(text_col) > 0).select(*_content_key(F.col(text_col)), F.col(text_col).alias("text"))
    passages = staged(source.mapInArrow(_found_passages(shared), "h1 long, h2 long, start long, words binary").distinct(), "passages")
    shared.unpersist()
    found = None
    for k in range(passes):
        rows = [(r.item, bytes(r.words)) for r in pieces.where(part == k).select("item", "words").collect()]
        tests = spark.sparkContext.broadcast(TestSuffixes(rows, window))
        out = staged(passages.mapInArrow(_matched(tests, shard_words), "h1 long, h2 long, start long, length long, item string"), "matches")
        tests.unpersist()
        found = out if found is None else found.unionByName(out)
    drop_staged(passages)
    drop_staged(pieces)
    return found.groupBy("h1", "h2").agg(F.array_sort(F.collect_set(F.struct("start", "length", "item"))).alias("matches"))


def _content_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("again"), text).alias("h2")


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with n_words and matches: every longest verbatim run shared with an item (start, length in words, item).

    A match is ``window`` words at least, or all words of an item that has fewer; across two pieces of an item of more than
    ``PIECE_WORDS`` words it is given as two that overlap. Texts are never shuffled unless more than
    ``BROADCAST_ROWS`` matches make the join back to the rows one of two large tables. Null and empty texts have no words and
    no matches; items without words match nothing; item ids are read as strings, rows of one id are one item, and so are
    those of a null id; repeated rows repeat in the result. Columns of ``docs`` named n_words or matches are replaced, other
    names can't clash.
    """
    found = staged(content_matches(docs, benchmark, text_col, **how), "matched")
    weight = found.agg(F.coalesce(F.sum(F.size("matches") + 1), F.lit(0))).first()[0]
    plain = [c for c in docs.columns if c not in ("n_words", "matches") or c == text_col]
    a, b, c, d, m = fresh(docs, "a", "b", "c", "d", "m")
    h1, h2 = _content_key(F.col(text_col))
    found = found.select(F.col("h1").alias(c), F.col("h2").alias(d), F.col("matches").alias(m))
    found = F.broadcast(found) if weight <= BROADCAST_ROWS else found
    joined = docs.withColumn(a, h1).withColumn(b, h2).join(found, (F.col(a) == F.col(c)) & (F.col(b) == F.col(d)), "left")
    none = F.from_json(F.lit("[]"), MATCH)
    return joined.select(*[F.col(f"`{name}`") for name in plain], count_words(F.col(text_col)).alias("n_words"), F.coalesce(F.col(m), none).alias("matches"))


def words_hit(matches: Column) -> Column:
    """Number of words inside any match; overlapping matches count once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def add(acc, m):
        end = m["start"] + m["length"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(m["start"], acc["upto"]))).alias("n"), F.greatest(acc["upto"], end).alias("upto"))

    return F.when(F.size(matches) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(F.array_sort(matches), start, add, lambda acc: acc["n"]))


def item_list(matches: Column) -> Column:
    """The items matched, as sorted distinct strings; a null one comes last."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item"])))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that share no window with any benchmark item, with their own columns."""
    found = staged(content_matches(docs, benchmark, text_col, **how).select("h1", "h2"), "contaminated")
    a, b = fresh(docs, "a", "b")
    found = found.select(F.col("h1").alias(a), F.col("h2").alias(b))
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    h1, h2 = _content_key(F.col(text_col))
    return docs.join(found, (h1 == F.col(a)) & (h2 == F.col(b)), "left_anti")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[j:j + {WINDOW - 1}], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS j FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
spots AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM d, lengths WHERE len(w) >= n),
hits AS (SELECT r, j, s.n, item_id FROM spots s JOIN windows ON s.n = windows.n AND array_to_string(w[j:j + s.n - 1], ' ') = k),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(j, j + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""
