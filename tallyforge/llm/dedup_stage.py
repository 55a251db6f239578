"""Near-duplicate stage: candidates by an exact prefix filter on word shingles, verified by exact Jaccard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, spanning_stars
from .shared import drop_staged, each_text, for_join, fresh, group_bounds, lower_words, staged, whole_groups

SHINGLE, SIMILARITY = 5, 0.8
BLOCK = 400
#: Rounds of representatives by which a large group is peeled.
ROUNDS = 3
#: Bytes of representatives up to which they are sent to every task.
BROADCAST_BYTES = 32 << 20
#: Texts whose shingles a task holds at once.
TEXTS_AT_ONCE = 200
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The one shingle of a text without words, so that such texts meet.
_NO_WORDS = np.array([0x51ED270B], np.uint64)


def _shingles(text: bytes, size: int) -> np.ndarray:
    """64-bit hashes of the word shingles in order; of the whole sequence if it is shorter; none without words."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = {}
    for w in set(words):
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = (out ^ h[j : j + len(out)]) * _MIX
        out ^= out >> np.uint64(32)
    return out


def _shared_at_least(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles that a text of so many must share with any text at ``similarity`` or more, rounded to the safe side."""
    return np.maximum(np.ceil(similarity * sizes - 1e-6), 1).astype(np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, h1, text) of every row with an id; null texts count as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("node"), F.xxhash64(text).alias("h1"), text.alias("text"))


def _meetings(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles that a text of so many shares with any such text within their prefixes, if both are of this size."""
    return np.minimum(np.maximum(sizes // 10, 1), _shared_at_least(sizes, similarity))


def shingle_table(rows: DataFrame, similarity: float, prefix: bool) -> DataFrame:
    """(node, h1, size, token): the distinct shingles of each text.

    With ``prefix`` (h1, least, token): only the lowest, so many that two texts at ``similarity`` have ``least`` of them in
    common, whichever of the two sets it.
    """

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                sets = [np.unique(_shingles(t, SHINGLE)) for t in each_text(batch.column(2).slice(lo, TEXTS_AT_ONCE))]
                sets = [s if len(s) else _NO_WORDS for s in sets]
                sizes = np.array([len(s) for s in sets])
                need = _shared_at_least(sizes, similarity)
                take = sizes - need + _meetings(sizes, similarity) if prefix else sizes
                at = np.repeat(np.arange(len(sets)), take)
                token = np.concatenate([s[:n] for s, n in zip(sets, take.tolist())]).view(np.int64)
                node, h1 = (c.slice(lo, TEXTS_AT_ONCE).to_numpy(zero_copy_only=False)[at] for c in batch.columns[:2])
                if prefix:  # the other text has need shingles at least
                    least = _meetings(need, similarity).astype(np.int32)[at]
                    yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(least), pa.array(token)], ["h1", "least", "token"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node, h1, sizes[at], token)], ["node", "h1", "size", "token"])

    out = "h1 long, least int, token long" if prefix else "node long, h1 long, size long, token long"
    return rows.select("node", "h1", "text").mapInArrow(run, out)


def _met(batches):
    """(h1, least, n): how many of a text's shingles here another text has too."""
    for table in whole_groups(batches, ["token"]):
        h1, least, token = (table.column(c).to_numpy() for c in ("h1", "least", "token"))
        once = np.zeros(len(token), np.int64)
        once[group_bounds(token, h1)[:-1]] = 1
        bounds = group_bounds(token)
        shared = np.repeat(np.add.reduceat(once, bounds[:-1]) > 1, np.diff(bounds)) & (once == 1)
        text, i, n = np.unique(h1[shared], return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(text), pa.array(least[shared][i]), pa.array(n)], ["h1", "least", "n"])


def _rarest(similarity: float):
    """Of each text's shingles that other texts have too, in order of frequency, the first that any partner must share."""

    def run(batches):
        for table in whole_groups(batches, ["node", "h1"]):
            node, h1, size, token = (table.column(c).to_numpy() for c in ("node", "h1", "size", "token"))
            bounds = group_bounds(node, h1)
            held = np.diff(bounds)
            take = held - _shared_at_least(size[bounds[:-1]], similarity) + 1
            keep = np.arange(len(node)) - np.repeat(bounds[:-1], held) < np.repeat(take, held)
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(token[keep])], ["node", "token"])

    return run


def meeting_buckets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY) -> DataFrame:
    """(node, token): every two texts at ``similarity`` or more have a token in common.

    Such texts share at least that part of either one's shingles, so in any common order of all shingles their prefixes of
    the other part and k more have k members in common. A text whose prefix in hash order meets others in fewer is done.
    For the rest shingles are ordered by how many texts have them: those of one text alone come first and meet nothing, so
    only texts with enough shared shingles go on, and they meet in their rarest ones. Both steps lose no pair.
    """
    rows = _rows(docs, id_col, text_col)
    prefix = shingle_table(rows, similarity, True).repartition("token").sortWithinPartitions("token", "h1")
    met = prefix.mapInArrow(_met, "h1 long, least int, n long").groupBy("h1").agg(F.max("least").alias("least"), F.sum("n").alias("n")).where("n >= least")
    alive = for_join(nodes.select("node", "h1").join(met.select("h1"), "h1"), "meeting")
    tokens = staged(shingle_table(rows.join(alive, ["node", "h1"]), similarity, False), "shingles")
    often = tokens.groupBy("token").count().where("count > 1")
    ranked = tokens.join(often, "token").repartition("node", "h1").sortWithinPartitions("node", "h1", "count", "token")
    buckets = staged(ranked.mapInArrow(_rarest(similarity), "node long, token long"), "rarest")
    drop_staged(tokens)
    return buckets


def candidate_groups(buckets: DataFrame) -> DataFrame:
    """(node, component): groups that hold every pair of texts that meet in a bucket (node, token)."""
    first = buckets.groupBy("token").agg(F.min("node").alias("first"))
    links = buckets.join(first, "token").where("node <> first").select(F.col("node").alias("src"), F.col("first").alias("dst"))
    return connected_components(links)


def _verified(texts: list[bytes], own: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose exact Jaccard similarity reaches ``least``; between blocks only, if there are two."""
    sets = [np.unique(_shingles(t, SHINGLE)) for t in texts]
    sizes = np.array([len(s) for s in sets], np.float64)
    hashes, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, flat, count = np.unique(hashes, return_inverse=True, return_counts=True)
    keep = count[flat] > 1
    flat, doc = flat[keep], doc[keep]
    order = np.argsort(flat, kind="stable")
    _, column = np.unique(flat[order], return_inverse=True)
    doc = doc[order]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + 4096, 4096))
    for lo, hi in zip(edges[:-1], edges[1:]):
        if lo < hi:
            m = np.zeros((len(sets), 4096), np.float32)
            m[doc[lo:hi], column[lo:hi] % 4096] = 1
            shared += m @ m.T
    both = sizes[:, None] + sizes[None, :] - shared
    near = (shared >= least * both) | (both == 0)
    if own.min() != own.max():
        near &= own[:, None] != own[None, :]
    i, j = np.nonzero(np.triu(near, 1))
    return i, j


def _similarity(batches):
    """(component, node, rep, sim): each text against its group's representative."""
    held: tuple = (None, None)
    for batch in batches:
        component, node, rep = (batch.column(c).to_numpy() for c in ("component", "node", "rep"))
        sims = np.zeros(len(node))
        for i, text in enumerate(each_text(batch.column("text"))):
            if held[0] != rep[i]:
                held = rep[i], np.unique(_shingles(batch.column("rep_text")[i].as_py().encode(), SHINGLE))
            own = np.unique(_shingles(text, SHINGLE))
            shared = len(np.intersect1d(own, held[1], assume_unique=True))
            both = len(own) + len(held[1]) - shared
            sims[i] = shared / both if both else 1.0
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (component, node, rep, sims)], ["component", "node", "rep", "sim"])


def stars(texts: DataFrame, similarity: float, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Peels groups (component, node, text) by representatives, one for each group and round.

    Returns (component, node, star, rep) of the texts that reach ``similarity`` with a representative, (component, node) of the
    rest, and (component, node, star, sim) of every comparison that did not reach it.
    """
    rest, found, apart = texts.select("component", "node"), None, None
    for star in range(rounds):
        first = rest.groupBy("component").agg(F.min(F.struct(F.xxhash64("node").alias("o"), "node")).alias("x")).select("component", F.col("x.node").alias("node"))
        reps = staged(texts.join(first, ["component", "node"]).select("component", F.col("node").alias("rep"), F.col("text").alias("rep_text")), "representatives")
        size = reps.agg(F.coalesce(F.sum(F.octet_length("rep_text")), F.lit(0))).first()[0]
        todo = texts.join(rest, ["component", "node"], "left_semi").join(F.broadcast(reps) if size <= BROADCAST_BYTES else reps, "component")
        sims = staged(todo.select("component", "node", "rep", "text", "rep_text").mapInArrow(_similarity, "component long, node long, rep long, sim double"), "similar").withColumn("star", F.lit(star))
        near, far = sims.where(F.col("sim") >= similarity), sims.where(F.col("sim") < similarity)
        found = near if found is None else found.unionByName(near)
        apart = far if apart is None else apart.unionByName(far)
        rest = far.select("component", "node")
        if rest.isEmpty():
            break
    return found.select("component", "node", "star", "rep"), rest, apart.select("component", "node", "star", "sim")


def _across(texts: DataFrame, left: DataFrame, right: DataFrame, block: int) -> DataFrame:
    """Rows (component, pair, own, node, text) that bring every text of ``left`` together with every text of ``right`` of the
    same (component, key), in pairs of blocks."""
    sides = []
    for own, side in ((0, left), (1, right)):
        cut = side.groupBy("component", "key").agg(F.ceil(F.count("*") / block).cast("long").alias(f"cut{own}"))
        sides.append((side, cut))
    cuts = for_join(sides[0][1].join(sides[1][1], ["component", "key"]), "cuts")
    out = None
    for own, (side, _) in enumerate(sides):
        mine, other = F.pmod(F.xxhash64("node"), F.col(f"cut{own}")), F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"cut{1 - own}") - 1))
        rows = side.join(cuts, ["component", "key"]).select("component", "key", "node", mine.alias("mine"), other.alias("other"), "cut1")
        b = (F.col("mine"), F.col("other")) if own == 0 else (F.col("other"), F.col("mine"))
        rows = rows.select("component", F.xxhash64("key", (b[0] * F.col("cut1") + b[1])).alias("pair"), F.lit(own).cast("long").alias("own"), "node")
        out = rows if out is None else out.unionByName(rows)
    return texts.join(for_join(out, "across"), ["component", "node"]).select("component", "pair", "own", "node", "text")


def _within(texts: DataFrame, nodes: DataFrame, block: int, *by: str) -> DataFrame:
    """Rows (component, pair, own, node, text) that bring every two texts of a component, and of equal ``by``, among ``nodes``
    together."""
    cuts = nodes.groupBy("component", *by).agg(F.ceil(F.count("*") / block).cast("long").alias("cut"))
    dealt = nodes.join(for_join(cuts, "cuts"), ["component", *by]).withColumn("own", F.pmod(F.xxhash64("node"), "cut"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1)))
    dealt = dealt.select("component", F.xxhash64(*by, F.least("own", "other"), F.greatest("own", "other")).alias("pair"), "own", "node")
    return texts.join(for_join(dealt, "within"), ["component", "node"]).select("component", "pair", "own", "node", "text")


def remaining_pairs(texts: DataFrame, rest: DataFrame, buckets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (component, pair, own, node, text) that bring every two texts among ``rest`` (component, node) together that meet
    in a bucket (node, token).

    Buckets of the same texts are one, so neighbouring shingles of a passage count once. A component whose texts would be
    sent more often by buckets than by all its pairs of blocks is compared as a whole, which covers its buckets.
    """
    met = staged(buckets.join(for_join(rest, "rest"), "node").select("component", "token", "node").distinct(), "met")
    members = [F.bit_xor(F.xxhash64(*salt, "node")).alias(name) for name, salt in (("x", ()), ("y", (F.lit("again"),)))]
    sizes = met.groupBy("component", "token").agg(F.count("*").alias("n"), *members).where("n > 1")
    kept = staged(sizes.groupBy("component", "n", "x", "y").agg(F.min("token").alias("token")), "rest-buckets")
    sent = lambda n: n * F.ceil(n / block)
    by_bucket = kept.groupBy("component").agg(F.sum(sent(F.col("n"))).alias("dealt"))
    whole = rest.groupBy("component").agg(sent(F.count("*")).alias("whole")).join(by_bucket, "component", "left").where("whole <= coalesce(dealt, 0)")
    whole = for_join(whole.select("component"), "whole")
    dealt = met.join(for_join(kept.select("component", "token"), "kept-buckets"), ["component", "token"]).join(whole, "component", "left_anti")
    return _within(texts, rest.join(whole, "component", "left_semi"), block).unionByName(_within(texts, dealt, block, "token"))


def verified_links(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY, block: int = BLOCK, buckets: DataFrame | None = None) -> DataFrame:
    """(src, dst): links of at least ``similarity`` within the candidate groups (node, h1, component), as spanning sets.

    A group of up to ``block`` texts is compared by one task. A larger one is first peeled by representatives: a text that
    reaches the similarity with one is linked, and texts of one star need no comparison with each other. What is left is
    compared where it meets in ``buckets`` (node, token), or among itself without them, and with a star only where it can be close to one of its texts: one less the Jaccard similarity is
    a metric, so with d = 1 - ``similarity`` a text further than 2 d from a representative is further than d from its star,
    and stars whose representatives are further apart than 3 d have no link. So a group of near copies costs its size, and
    so does a group of texts that share rare shingles but are not near, such as pages made of one pool of sentences.
    """
    rows = _rows(docs, id_col, text_col)
    large = for_join(groups.groupBy("component").count().where(F.col("count") > block).select("component"), "large-groups")
    small = groups.join(large, "component", "left_anti")
    zero = F.lit(0).cast("long")
    keyed = rows.join(for_join(small, "to-verify"), ["node", "h1"]).select("component", zero.alias("pair"), zero.alias("own"), "node", "text")
    direct = None
    if not large.isEmpty():
        members = groups.join(large, "component", "left_semi")
        texts = staged(rows.join(for_join(members, "members"), ["node", "h1"]).select("component", "node", "text").dropDuplicates(["component", "node"]), "large-texts")
        found, rest, apart = stars(texts, similarity)
        direct = found.where("node <> rep").select(F.col("node").alias("src"), F.col("rep").alias("dst"))
        reach = 1 - similarity + 1e-9
        of_star = found.select("component", F.col("star").cast("string").alias("key"), "node")
        near_rest = apart.where(1 - F.col("sim") <= 2 * reach).join(rest, ["component", "node"], "left_semi").select("component", F.col("star").cast("string").alias("key"), "node")
        reps = found.where("node = rep").select("component", "node", F.col("star").alias("other"))
        close = apart.where(1 - F.col("sim") <= 3 * reach).join(reps, ["component", "node"]).select("component", "star", "other")
        key = F.concat_ws("-", F.col("star").cast("string"), F.col("other").cast("string")).alias("key")
        ends = [found.select("component", "node", F.col("star").alias(end)).join(close, ["component", end]).select("component", key, "node") for end in ("star", "other")]
        within = _within(texts, rest, block) if buckets is None else remaining_pairs(texts, rest, buckets, block)
        for part in (within, _across(texts, near_rest, of_star, block), _across(texts, *ends, block)):
            keyed = keyed.unionByName(part)

    def run(batches):
        for table in whole_groups(batches, ["component", "pair"]):
            node, side = table.column("node").to_numpy(), table.column("own").to_numpy()
            texts = table.column("text").combine_chunks()
            bounds = group_bounds(table.column("component").to_numpy(), table.column("pair").to_numpy())
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo > 1:
                    i, j = _verified([*each_text(texts.slice(lo, hi - lo))], side[lo:hi], similarity)
                    if len(i):
                        a, b = spanning_stars(node[lo:hi][i], node[lo:hi][j])
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    keyed = keyed.repartition("component", "pair").sortWithinPartitions("component", "pair")
    links = keyed.mapInArrow(run, "src long, dst long")
    return links if direct is None else links.unionByName(direct)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, links: DataFrame | None = None) -> DataFrame:
    """``docs`` without near-duplicates: of each group of texts linked at ``similarity`` or more (Jaccard of five-word
    shingles, lower-cased) the row with the smallest id stays.

    Candidates come from an exact prefix filter, so no link is missed, and
    every link is then verified exactly. Copies are folded by content first. Null texts count as empty, and empty texts are
    copies of each other; rows with a null id stay; of rows equal in id and text one stays. All columns are kept.
    ``links`` (src, dst) are further links between ids, found by another method; groups are made of both.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashes = _rows(docs, id_col, text_col).select(F.col("node").alias("id"), "h1", F.xxhash64(F.lit("text"), "text").alias("h2"))
    contents = staged(hashes, "contents")
    nodes = staged(contents.groupBy("h1", "h2").agg(F.min("id").alias("node")), "content-nodes")
    buckets = meeting_buckets(docs, nodes, id_col, text_col, similarity)
    groups = candidate_groups(buckets)
    roots = groups.select("component").distinct().select(F.col("component").alias("node"), "component")
    groups = staged(groups.unionByName(roots).join(nodes.select("node", "h1"), "node"), "candidates")
    found = verified_links(docs, groups, id_col, text_col, similarity, buckets=buckets)
    final = connected_components(found if links is None else found.unionByName(links))
    drop_staged(buckets)
    stays = nodes.join(final, "node", "left_anti").select(F.col("node").alias("id"), "h1")
    gone = for_join(contents.select("id", "h1").join(stays, ["id", "h1"], "left_anti").distinct(), "gone")
    mark, a, b = fresh(docs, "h1", "a", "b")
    gone = gone.select(F.col("id").alias(a), F.col("h1").alias(b))
    kept = docs.withColumn(mark, F.xxhash64(text)).join(gone, (F.col(id_col).cast("long") == F.col(a)) & (F.col(mark) == F.col(b)), "left_anti")
    if contents.groupBy("id", "h1").count().where("count > 1").limit(1).count():
        kept = kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, mark]).unionByName(kept.where(F.col(id_col).isNull()))
    return kept.drop(mark)
