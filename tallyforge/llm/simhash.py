"""SimHash near-duplicates: generalised pigeonhole over correlated bit parts with thresholds from a cost estimate."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, spanning_stars
from .shared import each_text, for_join, group_bounds, lower_words, staged, whole_groups

BITS = 64
#: Members of one bucket that a single task compares; a larger bucket is cut into pairs of blocks of this size.
BLOCK = 4096
#: Relative costs for the estimate: moving one signature row, comparing one candidate pair.
ROW_COST, PAIR_COST = 40.0, 1.0


def simhash(text: bytes, shingle: int, seed: int) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = lower_words(text)
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: n - shingle + 1].tolist()
    digest, total, m = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), n - shingle + 1
    stops = (ends[shingle - 1 :] - 1).tolist()
    for lo in range(0, m, 1 << 16):
        h = [digest(joined[a:b], seed) for a, b in zip(starts[lo : lo + (1 << 16)], stops[lo : lo + (1 << 16)])]
        total += bit_totals(np.array(h, np.uint64))
    return int(np.packbits(2 * total > m).view(">u8")[0])


def bit_totals(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set, highest bit first. Eight byte-wide counters are added at a time,
    over runs of 255 values so that none overflows."""
    runs = -(-len(h) // 255)
    padded = np.zeros(runs * 255, ">u8")
    padded[: len(h)] = h
    lanes = np.unpackbits(padded.view(np.uint8)).view(np.uint64).reshape(runs, 255, 8)
    return lanes.sum(axis=1).view(np.uint8).reshape(runs, BITS).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """(id, fp0, fp1, ...): one signed 64-bit fingerprint for each seed. Null and empty texts get 0; other columns of
    ``docs`` are left out, so their names can't clash."""
    names = [f"fp{i}" for i in range(len(seeds))]

    def run(batches):
        for batch in batches:
            fps = np.array([[simhash(t, shingle, s) for s in seeds] for t in each_text(batch.column(1))], np.uint64).reshape(-1, len(seeds)).view(np.int64).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, fps)], ["id", *names])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ", ".join([f"id {kind}", *(f"{x} long" for x in names)]))


@dataclass(frozen=True)
class Part:
    """Bits that are looked up together, and how many of them may differ."""

    bits: tuple[int, ...]
    threshold: int


def bit_counts(fps: DataFrame, fp: str) -> tuple[int, np.ndarray]:
    """(rows, 64 x 64 counts of rows in which both bits are set), over all rows."""

    def run(batches):
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(x), 1 << 15):
                m = ((x[lo : lo + (1 << 15), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += m.T @ m
            rows += len(x)
        cells = np.append(total.ravel().astype(np.int64), rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    out = dict(map(tuple, fps.select(fp).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()))
    cells = np.array([out.get(i, 0) for i in range(BITS * BITS + 1)], np.float64)
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _parts_of(corr: np.ndarray, m: int) -> list[list[int]]:
    """Cut the bits into m parts of nearly equal size, each grown by the bit that correlates most with it."""
    left, parts = set(range(BITS)), []
    for k in range(m):
        want = (BITS * (k + 1)) // m - (BITS * k) // m
        part = [max(left, key=lambda b: (corr[b, list(left)].sum(), -b))]
        left.discard(part[0])
        while len(part) < want:
            b = max(left, key=lambda x: (corr[x, part].sum(), -x))
            part.append(b)
            left.discard(b)
        parts.append(part)
    return parts


def _differing(part: list[int], corr: np.ndarray, ones: np.ndarray, both: np.ndarray, n: int) -> np.ndarray:
    """Estimated chances that two rows differ in 0, 1, 2, ... bits of a part: each bit given its most correlated forerunner."""
    dist = np.array([1.0])
    for i, b in enumerate(part):
        p = ones[b] / n
        agree = p * p + (1 - p) * (1 - p)
        if i:
            a = part[int(np.argmax(corr[b, part[:i]]))]
            q = both[a, b] / n
            cells = np.array([q, ones[a] / n - q, p - q, 1 - p - ones[a] / n + q]).clip(0)
            pa_ = ones[a] / n
            agree = (cells**2).sum() / max(pa_ * pa_ + (1 - pa_) * (1 - pa_), 1e-12)
        agree = min(max(agree, 0.0), 1.0)
        dist = np.convolve(dist, [agree, 1 - agree])
    return dist


def plan_parts(fps: DataFrame, fp: str, radius: int, max_parts: int = 12) -> list[Part]:
    """Choose parts and thresholds for a search radius.

    By the general pigeonhole principle any two rows within ``radius`` agree in some part i up to t_i bits, if the t_i
    add up to radius - parts + 1 (t = -1 leaves a part out). For each number of parts a dynamic programme over the parts
    spends that sum where the estimated cost (signature rows plus candidate pairs) grows least; the cheapest wins.
    All figures come from bit counts over every row.
    """
    n, both = bit_counts(fps, fp)
    if n < 2:
        return [Part(tuple(range(BITS // 2)), radius // 2), Part(tuple(range(BITS // 2, BITS)), radius - 1 - radius // 2)]
    ones = np.diag(both).copy()
    cov = both / n - np.outer(ones, ones) / n**2
    sd = np.sqrt(np.diag(cov).clip(1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    best: tuple[float, list[Part]] | None = None
    for m in range(2, max_parts + 1):
        total = radius - m + 1
        if total < -m:
            break
        parts = _parts_of(corr, m)
        table = {0: (0.0, [])}
        for part in parts:
            near = np.cumsum(_differing(part, corr, ones, both, n))
            new: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, ts) in table.items():
                for t in range(-1, min(4, len(part), total + m) + 1):
                    rows = sum(_choose(len(part), k) for k in range(1, t + 1)) / 2 + 1 if t >= 0 else 0
                    c = cost + (n * rows * ROW_COST + n * (n - 1) / 2 * near[t] * PAIR_COST if t >= 0 else 0)
                    s = spent + t
                    if s not in new or c < new[s][0]:
                        new[s] = (c, [*ts, t])
            table = new
        if total in table and (best is None or table[total][0] < best[0]):
            cost, ts = table[total]
            best = cost, [Part(tuple(sorted(p)), t) for p, t in zip(parts, ts) if t >= 0]
    return best[1]


def _choose(n: int, k: int) -> float:
    return float(np.prod([(n - i) / (i + 1) for i in range(k)]))


def _signatures(parts: list[Part]):
    """Rows (bucket, node, fp, probe). A row indexes its own value of each part, and probes the smaller values within the
    threshold: of two values that differ, the larger one has the highest differing bit set and probes."""

    def run(batches):
        for batch in batches:
            node = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False)
            x = fp.view(np.uint64)
            for k, part in enumerate(parts):
                value = np.zeros(len(x), np.uint64)
                for j, b in enumerate(part.bits):
                    value |= ((x >> np.uint64(b)) & np.uint64(1)) << np.uint64(j)
                for size in range(part.threshold + 1):
                    for mask in combinations(range(len(part.bits)), size):
                        keep = slice(None) if not size else (value >> np.uint64(mask[-1])) & np.uint64(1) == 1
                        v = value[keep] ^ np.uint64(sum(1 << j for j in mask))
                        bucket = (np.uint64(k) << np.uint64(58)) | v
                        if len(v):
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (bucket.view(np.int64), node[keep], fp[keep], np.full(len(v), size > 0))], ["bucket", "node", "fp", "probe"])

    return run


def _dealt(rows: DataFrame, hot: DataFrame, block: int) -> DataFrame:
    """Rows with ``pair``: 0, or for a hot bucket (bucket, count) each pair of blocks that has the row's own block."""
    cuts = hot.select("bucket", F.ceil(F.col("count") / block).cast("long").alias("cut"))
    cuts = for_join(cuts, "hot-buckets")
    if cuts.isEmpty():
        return rows.withColumn("pair", F.lit(0).cast("long"))
    cut = F.coalesce("cut", F.lit(1).cast("long"))
    rows = rows.join(cuts, "bucket", "left").withColumn("cut", cut).withColumn("own", F.pmod(F.xxhash64("fp"), "cut"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1)))
    return rows.select("bucket", (F.least("own", "other") * F.col("cut") + F.greatest("own", "other")).alias("pair"), "node", "fp", "probe")


def _near_in_buckets(radius: int, every_pair: bool):
    """Edges within buckets: small buckets row against row by shifts of the sorted table, large ones as a matrix."""
    wide = 96

    def run(batches):
        for table in whole_groups(batches, ["bucket", "pair"]):
            bucket, pair, node, fp = (table.column(c).to_numpy() for c in ("bucket", "pair", "node", "fp"))
            probe = table.column("probe").to_numpy(zero_copy_only=False).astype(bool)
            x = fp.view(np.uint64)
            bounds = group_bounds(bucket, pair)
            sizes = np.diff(bounds)
            group = np.repeat(np.arange(len(sizes)), sizes)
            small = (sizes <= wide)[group]
            src, dst = [], []
            for lag in range(1, int(sizes[sizes <= wide].max(initial=1))):
                i = np.flatnonzero((group[lag:] == group[:-lag]) & small[:-lag])
                j = i + lag
                near = (np.bitwise_count(x[i] ^ x[j]) <= radius) & ~(probe[i] & probe[j]) & (node[i] != node[j])
                src.append(node[i[near]])
                dst.append(node[j[near]])
            for g in np.flatnonzero(sizes > wide):
                s = slice(bounds[g], bounds[g + 1])
                for a, b in _near_in_matrix(node[s], x[s], probe[s], radius, every_pair):
                    src.append(a)
                    dst.append(b)
            if src and sum(map(len, src)):
                a, b = np.concatenate(src), np.concatenate(dst)
                if not every_pair:
                    a, b = spanning_stars(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    return run


def _near_in_matrix(node, x, probe, radius, every_pair):
    """Edges of one large bucket, indexed rows against all; without ``every_pair`` a spanning set of them suffices."""
    index = np.flatnonzero(~probe)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for lo in range(0, len(index), 256):
        rows = index[lo : lo + 256]
        i, j = np.nonzero(np.bitwise_count(x[rows, None] ^ x[None, :]) <= radius)
        near = node[rows[i]] != node[j]
        i, j = node[rows[i[near]]], node[j[near]]
        if every_pair:
            yield i, j
        elif len(i):
            a, b = spanning_stars(np.concatenate([a, i]), np.concatenate([b, j]))
    if len(a):
        yield a, b


def hamming_links(fps: DataFrame, radius: int = 3, node: str = "node", fp: str = "fp", parts: list[Part] | None = None, every_pair: bool = False, block: int = BLOCK) -> DataFrame:
    """(src, dst): links that join all fingerprints within ``radius`` bits into the same groups as all pairs would.

    ``fps`` has one row for each distinct fingerprint. No candidate is dropped: buckets beyond ``block`` rows are compared
    as pairs of blocks in separate tasks. ``every_pair`` returns each linked pair instead of a spanning set.
    """
    parts = parts or plan_parts(fps, fp, radius)
    source = fps.select(F.col(node).alias("node"), F.col(fp).alias("fp"))
    index = [Part(p.bits, 0) for p in parts]
    rows = "bucket long, node long, fp long, probe boolean"
    hot = source.mapInArrow(_signatures(index), rows).groupBy("bucket").count().where(F.col("count") > block)
    keyed = _dealt(source.mapInArrow(_signatures(parts), rows), hot, block).repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
    return keyed.mapInArrow(_near_in_buckets(radius, every_pair), "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp, component): the SimHash of each text and the smallest id that links of at most ``radius`` bits reach.

    Texts without words have fingerprint 0 and link like any other. Equal fingerprints are first folded into one node, so
    copies cost nothing in the search. Ids are integers; a row with a null id gets its fingerprint and a null component and
    links nothing. Repeated rows give repeated results; an empty table gives none.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle, (seed,)).withColumnRenamed("fp0", "fp"), "simhash")
    nodes = staged(fps.where("id is not null").groupBy("fp").agg(F.min("id").cast("long").alias("node")), "simhash-nodes")
    groups = connected_components(hamming_links(nodes, radius))
    named = nodes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    return fps.join(named, "fp", "left").select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def hex_fingerprint(column: str):
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
