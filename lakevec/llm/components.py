"""Connected components of an edge table, by alternating stars; what is small enough is finished in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: A node is a hub from so many edges on, or from this part of all edges on.
HUB_EDGES, HUBS = 1000, 10_000
#: So many edges (16 MB) or fewer are one task's work; the stars bring larger tables to their end.
LOCAL_EDGES = 1_000_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum((F.xxhash64("a", "b") % 1_000_003).cast("long")), F.lit(0))).first())


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    a, b = (table.column(c).to_numpy() for c in ("a", "b"))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        if (x == y).all():
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))  # the larger root hangs on the smaller
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[root] if len(nodes) else nodes, pa.int64())], names=["node", "component"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) can reach, for nodes that have an edge.

    Large stars hang all larger neighbours of a node on its smallest neighbour, small stars hang the smaller ones on
    it; both keep components as they are and shrink the tree's height fast. Edges are narrow rows in tables of the
    shared folder; minima are aggregated before the shuffle, and the edges of hubs, which may be most of all, are
    joined to their few minima by a broadcast.
    """
    turned = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = common.materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _state(edges)
    while seen[0] > LOCAL_EDGES:
        both = turned(edges)
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        # hubs: with so many edges each there are not more than 2 * HUBS of them; their edges stay where they are
        hub = F.col("n") >= max(HUB_EDGES, seen[0] // HUBS)
        hubs, larger = F.broadcast(least.where(hub).select("a", "m")), both.where("b > a")
        others = larger.join(F.broadcast(least.where(hub).select("a")), "a", "left_anti").join(least.where(~hub).select("a", "m"), "a")
        large = larger.join(hubs, "a").unionByName(others).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = common.materialise(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = common.materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    if seen[0] <= LOCAL_EDGES:
        return edges.coalesce(1).mapInArrow(_union, "node long, component long")
    roots = edges.groupBy("a").agg(F.min("b").alias("component"))
    return turned(edges).select(F.col("a").alias("node")).distinct().join(roots.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
