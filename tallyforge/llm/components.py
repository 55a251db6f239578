"""Connected components by alternating star steps; every step is a grouped minimum and a join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, drop_staged, staged


def spanning_stars(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of a small edge list, by vectorised label halving."""
    nodes, flat = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = flat[: len(src)], flat[len(src) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contract(batches):
    src, dst = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        src, dst = spanning_stars(np.concatenate([src, u]), np.concatenate([dst, v]))
    if len(src):
        yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["u", "v"])


#: Neighbours from which a node is a hub.
HUB = 1000


def _large_star(e: DataFrame) -> DataFrame:
    """(u, v): every larger neighbour of a node linked to the node's smallest one (the node itself counts as one).

    Hubs, of which there are at most edges / ``HUB``, are told apart and sent to every task, so that their edges are not
    dealt by hub; if they are too many for that, they are joined like others and Spark splits such partitions.
    """
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = lambda x: x.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    star = lambda x: x.select(F.col("v").alias("u"), F.col("m").alias("v"))
    hubs = staged(e.groupBy("v").count().where(F.col("count") > HUB).select(F.col("v").alias("u")), "hubs")
    if not 0 < hubs.count() <= BROADCAST_ROWS:
        return star(both.where("v > u").join(smallest(both), "u"))
    hub = F.broadcast(hubs)
    of_hubs = both.where("v > u").join(F.broadcast(smallest(both.join(hub, "u", "left_semi"))), "u")
    rest = both.join(hub, "u", "left_anti")
    return star(of_hubs).unionByName(star(rest.where("v > u").join(smallest(rest), "u")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    ``edges`` holds two long columns, in any order and direction, repeats and self-loops allowed. Each partition first
    shrinks its own edges to stars, then large-star and small-star steps alternate until every edge points at a root; each
    round joins further trees, so they end by themselves. Minima are aggregated with map-side combine.
    """
    u, v = edges.columns[:2]
    e = edges.select(F.greatest(u, v).cast("long").alias("u"), F.least(u, v).cast("long").alias("v")).where("u > v")
    e = staged(e.mapInArrow(_contract, "u long, v long"), "links")
    while True:
        large = _large_star(e)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.withColumnRenamed("m", "v")).where("u > v").distinct()
        new = staged(small, "links")
        drop_staged(e)
        e = new
        if e.join(e.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count() == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
