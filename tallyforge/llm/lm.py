"""LM scoring by a weighted backoff automaton whose counts never meet in one place.

Texts are packed into chunks of token numbers. Each chunk asks for the corpus counts of its own n-grams. The questions travel
through a butterfly: on each level a group of at most about ``FAN`` senders deals its n-grams to ``FAN`` ranges of hashes, where
they are added up, until one group is left and the sums are those of the corpus; the answers come back the same way. Rows grow
with the number of chunks (times ``FAN``), not with its square. A chunk then builds the part of the automaton that its texts
can reach (states are n-gram contexts, failure arcs lead to the next shorter one) and runs its texts through it.

Smoothing: P(w|h) = (1 - a) c(hw) / c(h) + a P(w|h') with a = D c(h)^-B for a context seen in training, else P(w|h'). D is the
share of a context seen once that goes to unseen words, n1 / (n1 + 2 n2); B is set so that contexts of c tokens have c^(1-B)
different followers, which must add up to the number of different n-grams. Both come from sums over the whole corpus. Every
P(.|h) adds up to 1.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_staged, group_bounds, held_out, lower_words, staged, text_bytes, whole_groups

FOLDS = 10
ALPHA = 0.1
ORDER = 3
CHUNK_BYTES = 4 << 20
#: Ranges of hashes that one level of the butterfly deals to, and senders that meet in one of its groups.
FAN = 512
#: Bits of an n-gram's hash beyond those that number the corpus's n-grams: a chance of 2^-20 to be taken for another one.
SPARE_BITS = 20
#: Tokens that one lane of the walk reads; longer texts are read in several lanes.
LANE = 512
#: Sums over different n-grams: how many were seen once, twice, and by powers of two.
N_STATS = 50
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The end and the start of a text are hashed with another seed than words, so no word shares their counts.
_END, _START = xxhash.xxh64_intdigest(b"end", 1), xxhash.xxh64_intdigest(b"start", 1)
ASK = "k long, grp long, range long, sender long, keys binary, own binary"
ANSWER = "k long, grp long, range long, part long, counts binary, stats array<long>"


def _squeeze(x: np.ndarray) -> bytes:
    """Whole numbers in few bytes: bytes of equal rank side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * _MIX


class Grams:
    """The tokens of a chunk and, for each order, its distinct n-grams in hash order.

    keys: their hashes; own: how often the chunk trains on each; at: for every token the n-gram that ends there (-1: none,
    an n-gram begins with the start of its text at most once); sample: for each n-gram a token where it ends.
    """

    def __init__(self, ids: np.ndarray, vocabulary: np.ndarray, lengths: np.ndarray, train: np.ndarray, order: int, bits: int):
        self.ids, self.end = ids, len(vocabulary)
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        hashes = _mixed(np.append(vocabulary, np.uint64(_END)))
        place = np.arange(len(ids)) - np.repeat(self.first[:-1], lengths)
        trained = np.repeat(train, lengths)
        by_hash = np.argsort(hashes)
        rank = np.empty(len(by_hash), np.int64)
        rank[by_hash] = np.arange(len(by_hash))
        self.keys, self.at = [hashes[by_hash]], [rank[ids]]
        gram = token = hashes[ids]
        for k in range(2, order + 1):
            before = np.concatenate([[np.uint64(0)], gram[:-1]])[: len(gram)]
            if k == 2:
                before[place == 0] = _mixed(np.array([_START], np.uint64))[0]
            gram = _mixed(before * _MIX + token)
            positions = np.flatnonzero(place >= k - 2)
            short = gram[positions] >> np.uint64(64 - bits) << np.uint64(64 - bits)
            by_hash = np.argsort(short)
            ordered = short[by_hash]
            new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)]
            at = np.full(len(token), -1)
            at[positions[by_hash]] = np.cumsum(new) - 1
            self.keys.append(ordered[new])
            self.at.append(at)
        self.own, self.sample = [], []
        for keys, at in zip(self.keys, self.at):
            self.own.append(np.bincount(at[trained & (at >= 0)], minlength=len(keys)).astype(np.uint64))
            sample = np.zeros(len(keys), np.int64)
            sample[at[at >= 0]] = np.flatnonzero(at >= 0)
            self.sample.append(sample)


def pack(docs: DataFrame, id_col: str, text_col: str, folds: int = FOLDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, n_tokens, ids, held, lengths, tokens, vocabulary): some ``CHUNK_BYTES`` of text to a chunk, as numbers of words
    (the end of a text has the number after the last word) and the words' hashes, and the number of tokens that train."""
    source = docs.select(F.col(id_col).alias("id"), held_out(id_col, folds).alias("held"), F.col(text_col).alias("text"))
    names = ["chunk", "n_tokens", "ids", "held", "lengths", "tokens", "vocabulary"]

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        slices, texts, size = [], [], 0

        def chunk():
            local: defaultdict[bytes, int] = defaultdict(count().__next__)
            rows = [[*map(local.__getitem__, lower_words(t)), -1] for t in texts]
            lengths = np.array([len(r) for r in rows], np.int32)
            tokens = np.fromiter(chain.from_iterable(rows), np.int32, int(lengths.sum()))
            tokens[tokens < 0] = len(local)
            words = np.fromiter(map(xxhash.xxh64_intdigest, local), np.uint64, len(local))
            table = pa.Table.from_batches(slices).combine_chunks()
            held = table.column("held").to_numpy().astype(bool)
            listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            lists = [listed(x) for x in (table.column("id").combine_chunks(), pa.array(held), pa.array(lengths))]
            cells = [pa.array([(part << 24) + n]), pa.array([int(lengths[~held].sum())]), *lists, pa.array([_squeeze(tokens)]), pa.array([_squeeze(words)])]
            return pa.RecordBatch.from_arrays(cells, names)

        for batch in batches:
            mine, lo = text_bytes(batch.column(2)), 0
            for i, t in enumerate(mine):
                size += len(t)
                if size >= chunk_bytes:
                    slices.append(batch.slice(lo, i + 1 - lo).select(["id", "held"]))
                    texts += mine[lo : i + 1]
                    yield chunk()
                    slices, texts, size, n, lo = [], [], 0, n + 1, i + 1
            if lo < batch.num_rows:
                slices.append(batch.slice(lo).select(["id", "held"]))
                texts += mine[lo:]
        if slices:
            yield chunk()

    kind = dict(docs.dtypes)[id_col]
    return source.mapInArrow(run, f"chunk long, n_tokens long, ids array<{kind}>, held array<boolean>, lengths array<int>, tokens binary, vocabulary binary")


def _grams(row: dict, order: int, bits: int) -> tuple[Grams, np.ndarray]:
    train = ~np.array(row["held"], bool)
    lengths = np.array(row["lengths"], np.int64)
    tokens, words = _expand(row["tokens"], np.int32).astype(np.int64), _expand(row["vocabulary"], np.uint64)
    return Grams(tokens, words, lengths, train, order, bits), train


def _cut(keys: np.ndarray, outer: int, level: int, fan: int) -> np.ndarray:
    """Where sorted hashes that fall into range ``outer`` of ``level`` are cut into the ``fan`` ranges below it."""
    edges = [((outer * fan + j) << 64) // fan ** (level + 1) for j in range(1, fan)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]])


def _packets(k: int, group: int, sender: int, outer: int, level: int, keys: np.ndarray, own: np.ndarray, fan: int) -> pa.RecordBatch:
    b = _cut(keys, outer, level, fan)
    full = [j for j in range(fan) if b[j] < b[j + 1]]
    n = len(full)
    cells = [pa.array([x] * n, pa.int64()) for x in (k, group)] + [pa.array([outer * fan + j for j in full], pa.int64()), pa.array([sender] * n, pa.int64())]
    cells += [pa.array([_squeeze(np.diff(keys[b[j] : b[j + 1]], prepend=np.uint64(0))) for j in full], pa.binary()), pa.array([_squeeze(own[b[j] : b[j + 1]]) for j in full], pa.binary())]
    return pa.RecordBatch.from_arrays(cells, ["k", "grp", "range", "sender", "keys", "own"])


def _group_of(sender: int, level: int, groups: int) -> int:
    return int((int(sender) * 0x9E3779B97F4A7C15 + level * 0xBF58476D1CE4E5B9) % (1 << 64) >> 20) % groups


def _ask(order: int, bits: int, groups: int, fan: int):
    """Level 0: the n-grams of each chunk, and how often it trains on each, dealt to ranges."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                grams, _ = _grams(row, order, bits)
                for k in range(order):
                    yield _packets(k, _group_of(row["chunk"], 0, groups), row["chunk"], 0, 0, grams.keys[k], grams.own[k], fan)

    return run


def _met(part: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Senders, their hashes, and over all of them the different hashes, the sums, and where each sender's hash stands."""
    part = part.sort_by("sender")
    senders = part.column("sender").to_pylist()
    keys = [np.cumsum(_expand(x, np.uint64), dtype=np.uint64) for x in part.column("keys").to_pylist()]
    own = np.concatenate([_expand(x, np.uint64) for x in part.column("own").to_pylist()])
    union, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return senders, keys, union, np.bincount(inverse, weights=own, minlength=len(union)).astype(np.int64), inverse


def _pass_on(level: int, groups: int, fan: int):
    """The next level: what the senders of a group have in a range goes on as the packets of one sender."""

    def run(batches):
        for table in whole_groups(batches, ["k", "grp", "range"]):
            for part in _parts(table):
                _, _, union, total, _ = _met(part)
                k, group, outer = (part.column(c)[0].as_py() for c in ("k", "grp", "range"))
                yield _packets(k, _group_of(group, level, groups), group, outer, level, union, total.astype(np.uint64), fan)

    return run


def _parts(table: pa.Table):
    bounds = group_bounds(*(table.column(c).to_numpy() for c in ("k", "grp", "range")))
    return (table.slice(lo, hi - lo) for lo, hi in zip(bounds[:-1], bounds[1:]))


def _replies(part: pa.Table, totals: np.ndarray | None, fan: int) -> pa.RecordBatch:
    """What each sender asked, answered from the sums of its group or, if given, from those of the level above."""
    senders, keys, _, total, inverse = _met(part)
    top = totals is None
    totals = total if top else totals
    counts = np.split(totals[inverse], np.cumsum([len(x) for x in keys])[:-1])
    k, here = (part.column(c)[0].as_py() for c in ("k", "range"))
    stats = [None] * len(senders)
    if top:
        log = np.zeros(N_STATS, np.int64)
        log[0], log[1] = (total == 1).sum(), (total == 2).sum()
        seen = total[total > 0]
        np.add.at(log, 2 + np.log2(np.maximum(seen, 1)).astype(np.int64), 1)
        stats[0] = log.tolist()
    n = len(senders)
    cells = [pa.array([k] * n, pa.int64()), pa.array(senders, pa.int64()), pa.array([here // fan] * n, pa.int64()), pa.array([here % fan] * n, pa.int64())]
    cells += [pa.array([_squeeze(c) for c in counts], pa.binary()), pa.array(stats, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(cells, ["k", "grp", "range", "part", "counts", "stats"])


def _top(fan: int):
    def run(batches):
        for table in whole_groups(batches, ["k", "grp", "range"]):
            for part in _parts(table):
                yield _replies(part, None, fan)

    return run


def _joined(answers: pa.Table) -> np.ndarray:
    """The answers to one sender, in the order of its hashes."""
    order = np.argsort(answers.column("part").to_numpy())
    parts = answers.column("counts").to_pylist()
    return np.concatenate([_expand(parts[i], np.int64) for i in order.tolist()])


def _relay(fan: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_replies(left, _joined(right), fan)])

    return run


def corpus_counts(chunks: DataFrame, order: int, bits: int, n_chunks: int, fan: int = FAN) -> tuple[DataFrame, np.ndarray]:
    """(k, grp = chunk, part, counts, ...): the corpus counts of each chunk's n-grams, and the sums of statistics by order."""
    groups = max(1, -(-n_chunks // fan))
    columns = chunks.select("chunk", "held", "lengths", "tokens", "vocabulary")
    asks = [columns.mapInArrow(_ask(order, bits, groups, fan), ASK)]
    dealt = lambda a: a.repartition("k", "grp", "range").sortWithinPartitions("k", "grp", "range")
    while groups > 1:
        asks[-1] = staged(asks[-1], "lm-asked")
        groups, level = max(1, -(-groups // fan)), len(asks)
        asks.append(dealt(asks[-1]).mapInArrow(_pass_on(level, groups, fan), ASK))
    answers = staged(dealt(asks[-1]).mapInArrow(_top(fan), ANSWER), "lm-answers")
    sums = answers.where("stats is not null").groupBy("k").agg(*[F.sum(F.element_at("stats", i + 1)) for i in range(N_STATS)]).collect()
    stats = np.zeros((order, N_STATS))
    for row in sums:
        stats[row[0]] = row[1:]
    for asked in reversed(asks[:-1]):
        keys = ["k", "grp", "range"]
        lower = staged(asked.groupBy(*keys).cogroup(answers.drop("stats").groupBy(*keys)).applyInArrow(_relay(fan), ANSWER), "lm-answers")
        drop_staged(answers)
        drop_staged(asked)
        answers = lower
    return answers, stats


def discounts(stats: np.ndarray, texts: int) -> list[tuple[float, float]]:
    """(D, B) for each context length from 1: see the module's text. The start of a text is one more context of length 1."""
    out = []
    for k in range(1, len(stats)):
        once, twice, contexts, different = stats[k][0], stats[k][1], stats[k - 1][2:].copy(), stats[k][2:].sum()
        d = min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5
        size = 1.5 * 2.0 ** np.arange(len(contexts))
        size[0] = 1.0
        if k == 1 and texts:
            contexts[int(np.log2(texts))] += 1
        low, high = 0.0, 1.0
        for _ in range(40):
            b = (low + high) / 2
            low, high = (b, high) if (contexts * size ** (1 - b)).sum() > different else (low, b)
        out.append((d, (low + high) / 2))
    return out


class Automaton:
    """The automaton's part that a chunk reaches.

    A state is a context seen in training, 0 to order - 1 words long: here the n-gram that ends at the token before. Reading a
    token takes the arc of the n-gram that ends at it, if it was seen; else a failure arc drops the state's first word at a
    price. ``seen``, ``price`` and ``fall`` hold arcs and failure arcs for each order and n-gram of the chunk.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, known: int, texts: int, smoothing: list[tuple[float, float]], alpha: float):
        self.grams, self.order, self.started = grams, len(counts), texts > 0
        base = np.log10((counts[0] + alpha) / (tokens + alpha * (known + 1)))
        self.base, self.known = base[grams.at[0]], (counts[0] > 0)[grams.at[0]]
        self.seen, self.price, self.fall = [counts[0] > 0], [base], []
        begins = np.zeros(len(grams.ids), bool)
        begins[grams.first[:-1]] = True
        p = 10.0**base
        for k in range(1, self.order):
            d, b = smoothing[k - 1]
            pos = grams.sample[k]
            context = np.where(begins[pos], texts, counts[k - 1][grams.at[k - 1][np.maximum(pos - 1, 0)]])
            shorter = p[grams.at[k - 1][pos]]
            keep = d * np.maximum(context, 1.0) ** -b
            p = np.where(context > 0, (1 - keep) * counts[k] / np.maximum(context, 1) + keep * shorter, shorter)
            self.seen.append(counts[k] > 0)
            self.price.append(np.log10(p))
            self.fall.append(np.log10(keep))  # by the n-gram that was not found: its context's failure arc

    def walk(self) -> np.ndarray:
        """Log10 probability of each text. One pass from left to right carries the state of every text; all texts move on
        by a token at a time. Long texts are cut into lanes that first read the order - 1 tokens before them, unpaid."""
        first, order, total = self.grams.first, self.order, np.zeros(len(self.grams.first) - 1)
        sizes = np.diff(first)
        pieces = -(-sizes // LANE)
        text = np.repeat(np.arange(len(sizes)), pieces)
        offset = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * LANE
        warm = np.minimum(offset, order - 1)
        start, stop = first[text] + offset - warm, first[text] + np.minimum(offset + LANE, sizes[text])
        by_length = np.argsort(start - stop, kind="stable")
        text, offset, warm, start, stop = (x[by_length] for x in (text, offset, warm, start, stop))
        depth = np.where((offset == 0) & self.started, min(1, order - 1), 0)
        paid = np.zeros(len(text))
        lengths = stop - start
        for j in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -j))  # lanes that have a token left
            at, d, cost = start[:n] + j, depth[:n], np.zeros(n)
            state = np.full(n, -1)
            for k in range(order - 1, -1, -1):
                here = np.flatnonzero((state < 0) & (d >= k))
                gram = self.grams.at[k][at[here]]
                arc = self.seen[k][gram] if k else np.ones(len(here), bool)
                cost[here[arc]] += self.price[k][gram[arc]]
                state[here[arc]] = np.minimum(k + self.seen[k][gram[arc]], order - 1)
                if k:
                    cost[here[~arc]] += self.fall[k - 1][gram[~arc]]
            depth[:n] = state
            paid[:n] += np.where(j >= warm[:n], cost, 0.0)
        np.add.at(total, text, paid)
        return total


def _run_chunk(order: int, bits: int, tokens: int, known: int, texts: int, smoothing, alpha: float, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        grams, train = _grams(left.select(["held", "lengths", "tokens", "vocabulary"]).to_pylist()[0], order, bits)
        ks = right.column("k").to_numpy()
        counts = [_joined(right.filter(pa.array(ks == k))) if (ks == k).any() else np.zeros(0, np.int64) for k in range(order)]
        model = Automaton(grams, counts, tokens, known, texts, smoothing, alpha)
        size, begin = np.diff(grams.first), grams.first[:-1]
        one, seen = np.add.reduceat(model.base, begin), np.add.reduceat(model.known.astype(np.int64), begin)
        ids = left.column("ids").combine_chunks().flatten()
        cells = [ids, pa.array(~train), pa.array(size), pa.array(seen), pa.array(np.full(len(size), tokens)), pa.array(one), pa.array(model.walk())]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cells, schema)], schema=schema)

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA, folds: int = FOLDS, fan: int = FAN, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    The model learns from the rows outside the held-out fold; the n-grams counted grow with the corpus, and no task holds
    more than a chunk or what meets of one range of hashes. Null texts are empty: one token, the end. Repeated rows count and
    return as often as they stand there; an empty table gives an empty result; rows of a null id train; other columns of
    ``docs`` are not read.
    """
    chunks = staged(pack(docs, id_col, text_col, folds, chunk_bytes), "lm-chunks")
    trained = F.size(F.filter("held", lambda x: ~x))
    total = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*"), F.coalesce(F.sum(trained), F.lit(0))).first()
    tokens, n_chunks, texts = map(int, total)
    bits = min(64, max(1, tokens).bit_length() + SPARE_BITS)
    answers, stats = corpus_counts(chunks, order, bits, n_chunks, fan)
    known = int(stats[0][2:].sum())
    kind = dict(docs.dtypes)[id_col]
    out = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    empty = docs.sparkSession.createDataFrame([], out).toArrow().schema
    groups = chunks.drop("n_tokens").groupBy("chunk").cogroup(answers.select("grp", "k", "part", "counts").groupBy("grp"))
    return groups.applyInArrow(_run_chunk(order, bits, tokens, known, texts, discounts(stats, texts), alpha, empty), out)
