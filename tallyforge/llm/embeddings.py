"""Embedding near-duplicates: a forest of random-projection trees with spill, comparison within leaves, union."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, spanning_stars
from .shared import for_join, group_bounds, staged, whole_groups

COSINE = 0.93
TREES = 6
#: Vectors that the first splits are fitted on at most; all vectors are indexed. Leaves that are still too large grow on by
#: samples of their own.
MAX_SAMPLE = 20_000
#: Bytes of components that the first splits are fitted on at most: 20 000 vectors of up to 1600 components, fewer beyond.
SAMPLE_BYTES = 256_000_000
#: Vectors of one leaf aimed at.
LEAF = 1500
#: Vectors that a leaf's own splits are fitted on, in each round of growth.
LEAF_SAMPLE = 512
#: Subtrees that are sent to every task, of some kilobytes each; more are joined by a shuffle.
MAX_TREES = 2_000
#: Half width of the band around a split whose vectors go to both sides.
SPILL = 0.025
#: Vectors of one leaf and label that one task compares; larger leaves are cut into pairs of blocks.
BLOCK = 2048


@dataclass(frozen=True)
class Node:
    """A split (direction, cut, two children) or, without children, a leaf with its number."""

    leaf: int = -1
    direction: np.ndarray | None = None
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(sample: np.ndarray, leaf_size: float, seed: int, first_leaf: int) -> tuple[Node, int]:
    """One tree over unit vectors, its leaves numbered from ``first_leaf``, and the next free number.

    A split is a random direction between two vectors, cut near the middle where the fewest vectors fall into the spill
    band. Where every tried split would send most vectors to both sides (a dense group), the node stays a leaf.
    """
    rng, free = np.random.default_rng(seed), [first_leaf]

    def leaf() -> Node:
        free[0] += 1
        return Node(leaf=free[0] - 1)

    def split(idx: np.ndarray, depth: int) -> Node:
        if len(idx) <= leaf_size or depth > 40:
            return leaf()
        best = None
        for _ in range(6):
            a, b = rng.choice(len(idx), 2, replace=False)
            direction = sample[idx[a]] - sample[idx[b]] + rng.normal(0, 0.05, sample.shape[1])
            direction /= np.linalg.norm(direction) or 1.0
            p = np.sort(sample[idx] @ direction)
            for q in (0.35, 0.45, 0.5, 0.55, 0.65):
                cut = p[int(q * (len(p) - 1))] + 1e-9
                left, right = np.searchsorted(p, cut + SPILL, "right"), len(p) - np.searchsorted(p, cut - SPILL)
                if best is None or max(left, right) < best[0]:
                    best = max(left, right), direction, cut
        if best[0] > 0.85 * len(idx):
            return leaf()
        _, direction, cut = best
        p = sample[idx] @ direction
        return Node(-1, direction, cut, split(idx[p <= cut + SPILL], depth + 1), split(idx[p >= cut - SPILL], depth + 1))

    root = split(np.arange(len(sample)), 0)
    return root, free[0]


def _route(root: Node, v: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows) of every leaf that unit vectors reach."""
    out, todo = [], [(root, np.arange(len(v)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node.direction is None:
            out.append((node.leaf, rows))
            continue
        p = v[rows] @ node.direction
        todo.append((node.left, rows[p <= node.cut + SPILL]))
        todo.append((node.right, rows[p >= node.cut - SPILL]))
    return out


def _units(column: pa.Array) -> np.ndarray:
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares of extreme values stay finite
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_forest(vectors: DataFrame, trees: int = TREES, leaf: int = LEAF, most: int = MAX_SAMPLE) -> tuple[list[Node], int]:
    """Trees over a sample of at most ``most`` vectors (the first by hash) and ``SAMPLE_BYTES``, and the dimension they split."""
    dims = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if dims is None:
        return [], 0
    picked = vectors.where(F.size("v") == dims["d"]).orderBy(F.xxhash64("node")).limit(max(1000, min(most, SAMPLE_BYTES // (8 * dims["d"])))).select("v").toArrow()
    sample = _units(picked.column("v").combine_chunks())
    size, roots, free = max(32.0, leaf * min(1.0, len(sample) / dims["count"])), [], 1
    for t in range(trees):
        root, free = grow(sample, size, 1000 + t, free)
        roots.append(root)
    return roots, dims["d"]


def _with_leaves(forest):
    """Rows (grp, node, copies, leaves, v): each vector with the leaves it falls into; leaf 0: another dimension (``_rooted``)."""

    def run(batches):
        roots, dim = forest.value
        for batch in batches:
            vectors = batch.column("v")
            fits = np.asarray(vectors.value_lengths()) == dim
            reached: list[list[int]] = [[] if f else [0] for f in fits]
            at = np.flatnonzero(fits)
            if len(at):
                unit = _units(vectors.take(pa.array(at)))
                for root in roots:
                    for leaf, rows in _route(root, unit):
                        for r in at[rows].tolist():
                            reached[r].append(leaf)
            lists = pa.array([sorted(x) for x in reached], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("node"), batch.column("copies"), lists, vectors], ["grp", "node", "copies", "leaves", "v"])

    return run


def _subtree(leaf_size: int):
    """(grp, leaf, tree) for the sampled vectors of one leaf; null where no split parts them."""

    def run(table: pa.Table) -> pa.Table:
        grp, leaf, total = (table.column(c)[0].as_py() for c in ("grp", "leaf", "total"))
        unit = _units(table.column("v").combine_chunks())
        least = max(8.0, leaf_size * len(unit) / total)
        root, _ = grow(unit, max(least, len(unit) / 12), leaf % (1 << 32), 0)  # about a dozen leaves at a time
        tree = None if root.direction is None else pickle.dumps(root)
        return pa.table({"grp": pa.array([grp], pa.int64()), "leaf": pa.array([leaf], pa.int64()), "tree": pa.array([tree], pa.binary())})

    return run


def _descend(batches):
    """Rows (grp, leaf, node) of the leaves below, numbered by a hash of the leaf above and the place in its tree."""
    for batch in batches:
        leaf, trees = batch.column("leaf").to_numpy(), batch.column("tree")
        out: tuple[list, list, list] = [], [], []
        grp, node = batch.column("grp").to_numpy(), batch.column("node").to_numpy()
        for key in np.unique(np.stack([grp, leaf]), axis=1).T:
            rows = np.flatnonzero((grp == key[0]) & (leaf == key[1]))
            root = pickle.loads(trees[int(rows[0])].as_py())
            for child, inside in _route(root, _units(batch.column("v").take(pa.array(rows)))):
                number = xxhash.xxh64_intdigest(f"{key[1]}/{child}") >> 1
                for column, x in zip(out, (grp[rows[inside]], np.full(len(inside), number), node[rows[inside]])):
                    column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in out], ["grp", "leaf", "node"])


def _rooted(base: DataFrame, trees: int, leaf: int) -> DataFrame:
    """``base`` with as many roots as trees (-1, -2, ...) for groups of more than ``leaf`` vectors that the first splits don't fit.

    They are of another dimension than most. Their trees grow as other large leaves do, each by samples of its own.
    """
    zero = F.col("leaves")[0] == 0
    large = base.where(zero).groupBy("grp").count().where(F.col("count") > leaf).select("grp", F.lit(True).alias("rooted"))
    if large.isEmpty():
        return base
    roots = F.when(F.col("rooted") & zero, F.array(*[F.lit(-t).cast("long") for t in range(trees, 0, -1)])).otherwise(F.col("leaves"))
    return staged(base.join(for_join(large, "rooted"), "grp", "left").withColumn("leaves", roots).drop("rooted"), "leaves")


def _grown(base: DataFrame, leaf: int, sample: int = LEAF_SAMPLE) -> DataFrame:
    """``base`` with the leaves grown on until none holds more than ``leaf`` vectors of a label, or no split parts it.

    Each round takes a sample of each leaf that is too large, grows a small tree on it where the sample lies, and sends only
    that leaf's vectors down that tree. Trees are joined to vectors by leaf, so no task and not the driver holds them all.
    """
    done, now, rounds = None, base.select("grp", F.explode("leaves").alias("leaf"), "node"), 0
    while True:
        big = staged(now.where("leaf <> 0").groupBy("grp", "leaf").agg(F.count("*").alias("total")).where(F.col("total") > leaf), "large-leaves")
        if big.isEmpty():
            break
        held = for_join(big, "large")
        picked = now.join(held, ["grp", "leaf"]).where(F.pmod(F.xxhash64("node", "leaf"), F.col("total")) < sample)
        vectors = base.select("node", "v")
        trees = picked.join(vectors, "node").select("grp", "leaf", "total", "v").groupBy("grp", "leaf").applyInArrow(_subtree(leaf), "grp long, leaf long, tree binary")
        trees = staged(trees.where("tree is not null"), "subtrees")
        if trees.isEmpty():
            break
        few = trees.count() <= MAX_TREES
        part = F.broadcast(trees) if few else trees
        rest = now.join(part.select("grp", "leaf"), ["grp", "leaf"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        moved = now.join(part, ["grp", "leaf"]).join(vectors, "node").select("grp", "leaf", "node", "tree", "v")
        now, rounds = staged(moved.mapInArrow(_descend, "grp long, leaf long, node long"), "leaves"), rounds + 1
    if not rounds:
        return base
    leaves = done.unionByName(now).groupBy("node").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    return base.drop("leaves").join(leaves, "node")


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """One row for each leaf of a vector; in a leaf beyond ``block`` vectors for each pair of blocks that has its own."""
    each = rows.withColumn("leaf", F.explode("leaves"))
    hot = each.groupBy("grp", "leaf").count().where(F.col("count") > block)
    cuts = for_join(hot.select("grp", "leaf", F.ceil(F.col("count") / block).cast("long").alias("cut")), "hot-leaves")
    zero = F.lit(0).cast("long")
    if cuts.isEmpty():
        return each.withColumn("own", zero).withColumn("pair", zero)
    each = each.join(cuts, ["grp", "leaf"], "left").withColumn("cut", F.coalesce("cut", F.lit(1).cast("long")))
    each = each.withColumn("own", F.pmod(F.xxhash64("node"), "cut")).withColumn("other", F.explode(F.sequence(zero, F.col("cut") - 1)))
    return each.withColumn("pair", F.least("own", "other") * F.col("cut") + F.greatest("own", "other"))


def _met_before(leaves: list[list[int]], leaf: int) -> np.ndarray | None:
    """Membership of rows in leaves of smaller number: rows that share one have been compared there."""
    earlier = [[x for x in own if x < leaf] for own in leaves]
    names = {x: i for i, x in enumerate(sorted({x for own in earlier for x in own}))}
    if not names:
        return None
    m = np.zeros((len(leaves), len(names)), np.float32)
    for r, own in enumerate(earlier):
        for x in own:
            m[r, names[x]] = 1
    return m


def _compare(cosine: float):
    """Rows (src, dst, n): dst null for counts of links, n null for links that span the groups."""

    def run(batches):
        for table in whole_groups(batches, ["grp", "leaf", "pair"]):
            bounds = group_bounds(*(table.column(c).to_numpy() for c in ("grp", "leaf", "pair")))
            src, dst, who, much = [], [], [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                part = table.slice(lo, hi - lo)
                node, copies, own = (part.column(c).to_numpy() for c in ("node", "copies", "own"))
                v = _units(part.column("v").combine_chunks())
                met = _met_before(part.column("leaves").to_pylist(), part.column("leaf")[0].as_py())
                two_blocks = own.min() != own.max()
                n = np.zeros(len(node), np.int64)
                for a in range(0, len(node), 512):
                    near = v[a : a + 512] @ v.T >= cosine
                    near[np.arange(len(near)), np.arange(a, a + len(near))] = False
                    if met is not None:
                        near &= met[a : a + 512] @ met.T == 0
                    if two_blocks:
                        near &= own[a : a + 512, None] != own[None, :]
                    n[a : a + 512] += near @ copies
                    i, j = np.nonzero(near)
                    if len(i):
                        s, d = spanning_stars(node[i + a], node[j])
                        src.append(s)
                        dst.append(d)
                who.append(node[n > 0])
                much.append(n[n > 0])
            if src:
                s, d = spanning_stars(np.concatenate(src), np.concatenate(dst))
                w, m = np.concatenate(who), np.concatenate(much)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([s, w])), pa.array(np.concatenate([d, w]), mask=np.arange(len(s) + len(w)) >= len(s)), pa.array(np.concatenate([d, m]), mask=np.arange(len(s) + len(w)) < len(s))],
                    ["src", "dst", "n"],
                )

    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK, grown: int | None = None, most: int = MAX_SAMPLE) -> DataFrame:
    """(id, n_links, component, kept): one row for each vector.

    Vectors of equal label and dimension link at ``cosine`` or more. Equal vectors are folded into one node that counts its
    copies. Each pair that shares a leaf is compared in the first such leaf only, so links are counted once and no pair is
    written out. Trees grow until no leaf holds more than ``grown`` vectors of a label (``leaf``, if not given); only
    a group so dense that no split parts it stays larger, and is compared as pairs of blocks of ``block``. Vectors that are null, zero or hold null
    or non-finite components, and rows with a null label, link with nothing. Rows that repeat an id count as one vector, the
    one of the smallest label and components; rows with a null id stay, unlinked, with a null component.
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    if rows.where("id is not null").groupBy("id").count().where("count > 1").limit(1).count():
        single = rows.where("id is not null").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
        rows = single.unionByName(rows.where("id is null"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    key = [F.xxhash64(F.col("label").cast("string"), F.size("v")).alias("grp"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("again"), "v").alias("h2")]
    used = rows.where(good).select(F.col("id").cast("long").alias("id"), *key, "v")
    folded = used.groupBy("grp", "h1", "h2").agg(F.min("id").alias("node"), F.count("id").alias("copies"))
    nodes = staged(used.join(folded.select("node", "copies"), used["id"] == F.col("node")).select("grp", "h1", "h2", "node", "copies", "v"), "vectors")
    grown = grown or leaf
    forest = table.sparkSession.sparkContext.broadcast(fit_forest(nodes, trees, leaf, most))
    kind = dict(nodes.dtypes)["v"]
    base = nodes.select("grp", "node", "copies", "v").mapInArrow(_with_leaves(forest), f"grp long, node long, copies long, leaves array<long>, v {kind}")
    leafed = _grown(_rooted(staged(base, "leaves"), trees, grown), grown)
    keyed = _dealt(leafed, block).select("grp", "leaf", "pair", "own", "node", "copies", "leaves", "v")
    keyed = keyed.repartition("grp", "leaf", "pair").sortWithinPartitions("grp", "leaf", "pair")
    found = staged(keyed.mapInArrow(_compare(cosine), "src long, dst long, n long"), "vector-links")
    counts = found.where("n is not null").groupBy(F.col("src").alias("node")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.where("dst is not null").select("src", "dst"))
    named = nodes.select("grp", "h1", "h2", "node", "copies").join(counts, "node", "left").join(groups, "node", "left")
    named = named.select("grp", "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("component"))
    linked = used.drop("v").join(named, ["grp", "h1", "h2"]).select("id", "n", "component")
    alone = rows.where(~F.coalesce(good, F.lit(False))).select(F.col("id").cast("long").alias("id"), F.lit(0).cast("long").alias("n"), F.col("id").cast("long").alias("component"))
    out = linked.unionByName(alone)
    return out.select("id", F.col("n").alias("n_links"), "component", F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


SQL = f"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM ok UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, e.vec_id) AS component_id, coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a
"""
