"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Rows are dealt to shards by a hash of their id, so copies of one vector, however many, are spread evenly; inside a
shard equal vectors are one node that keeps its smallest ids. Levels are built from the top down, each with the one
above as its entrance. Nodes are inserted in batches: a beam search over the graph so far and the batch itself give the
candidates, the diversity rule picks the neighbours, and reverse links are cut back by the same rule. All of this is
numpy over whole batches. A level is stored as its nodes and one flat array of neighbours.

Inner product is not a metric; one more component, sqrt(max |v|^2 - |v|^2), makes all vectors equally long, so that
links join near vectors and the largest inner product is the nearest neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

M, BEAM_BUILD, BEAM_SEARCH, K = 16, 80, 192, 20
#: A shard holds GROWTH times the square root of the number of rows, at least LEAST_ROWS, and its vectors take no more
#: than MOST_BYTES: a larger shard is searched faster than two, but one task builds it and one row holds it.
GROWTH, LEAST_ROWS, MOST_BYTES = 40, 4096, 64 << 20
#: Bytes of queries that are broadcast at once; inside a task, queries in one beam search.
QUERY_BYTES, TOGETHER, EXPANDED = 32 << 20, 256, 4
GRAPH = "shard int, dim int, n int, vectors binary, ids binary, starts binary, nodes array<binary>, neighbours array<binary>"
FOUND = "query_id long, vec_id long, score double"


def _unit(n: int) -> int:
    return max(1, min(TOGETHER, (32 << 20) // max(1, n)))


def beam(vectors: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, entrance: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes found for each query (-1: none), best first, and their products.

    ``neighbours`` has a row of node numbers for each node, -1 for none; ``entrance`` a row of nodes for each query.
    """
    q, n = len(queries), len(neighbours)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # the node -1
    best = np.full((q, width), -1, np.int64)
    score = np.full((q, width), -np.inf, np.float32)
    done = np.ones((q, width), bool)

    def take(at: np.ndarray, new: np.ndarray) -> None:
        """Merge the nodes ``new`` of the queries ``at``."""
        new = np.sort(new, 1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        fresh = ~seen[at[:, None], new]
        seen[at[:, None], new] = True
        s = np.full(new.shape, -np.inf, np.float32)
        where = np.nonzero(fresh)
        s[where] = np.einsum("ij,ij->i", vectors[new[where]], queries[at[where[0]]])
        all_s = np.concatenate([score[at], s], 1)
        order = np.argpartition(-all_s, width - 1, 1)[:, :width] if all_s.shape[1] > width else np.broadcast_to(np.arange(width), (len(at), width))
        part = np.take_along_axis(all_s, order, 1)
        order = np.take_along_axis(order, np.argsort(-part, 1, kind="stable"), 1)
        score[at] = np.take_along_axis(all_s, order, 1)
        best[at] = np.where(np.isinf(score[at]), -1, np.take_along_axis(np.concatenate([best[at], new], 1), order, 1))
        done[at] = np.take_along_axis(np.concatenate([done[at], ~fresh], 1), order, 1) | (best[at] < 0)

    take(np.arange(q), entrance.copy())
    live = np.arange(q)
    while len(live):
        open_ = ~done[live]
        some = open_.any(1)
        live, open_ = live[some], open_[some]
        if not len(live):
            break
        first = np.argsort(~open_, 1, kind="stable")[:, :EXPANDED]
        real = np.take_along_axis(open_, first, 1)
        nodes = np.take_along_axis(best[live], first, 1)
        done[live[:, None], first] = True
        new = neighbours[nodes]
        new = np.where(real[:, :, None], new, -1)
        take(live, new.reshape(len(live), -1))
    return best, score


def diverse(vectors: np.ndarray, candidates: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first, -1: none) at most ``most`` neighbours.

    A candidate that is nearer to a chosen one than to the row's own node waits; those that wait fill what is left.
    """
    b, c = candidates.shape
    if c <= most:
        return candidates
    x = vectors[np.maximum(candidates, 0)]
    among = np.matmul(x, x.transpose(0, 2, 1))
    chosen = np.zeros((b, c), bool)
    count = np.zeros(b, np.int64)
    for j in range(c):
        near = np.where(chosen, among[:, j], -np.inf).max(1)
        ok = (candidates[:, j] >= 0) & (near <= scores[:, j]) & (count < most)
        chosen[:, j] = ok
        count += ok
    rank = np.where(chosen, 0, np.where(candidates >= 0, 1, 2))
    order = np.argsort(rank, 1, kind="stable")[:, :most]
    return np.take_along_axis(candidates, order, 1)


class Level:
    """One level: ``neighbours`` by place, where place i is node ``nodes[i]``; lower places were inserted earlier."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, degree: int):
        self.nodes, self.degree = nodes, degree
        self.vectors = vectors[nodes]
        self.neighbours = np.full((len(nodes), degree), -1, np.int32)

    def insert(self, start: int, stop: int, entrance) -> None:
        new = np.arange(start, stop)
        x = self.vectors[new]
        inside = x @ x.T
        np.fill_diagonal(inside, -np.inf)
        own = min(BEAM_BUILD, len(new) - 1)
        near = np.argpartition(-inside, own - 1, 1)[:, :own] if own else np.zeros((len(new), 0), np.int64)
        found, score = near + start, np.take_along_axis(inside, near, 1)
        if start:
            begin = entrance(x)
            begin = np.where(begin < start, begin, -1)  # the level above may hold nodes that come later here
            begin[begin.max(1) < 0, 0] = 0
            ids, s = beam(self.vectors, self.neighbours[:start], x, begin, BEAM_BUILD)
            found, score = np.concatenate([found, ids], 1), np.concatenate([score, s], 1)
        order = np.argsort(-score, 1, kind="stable")[:, :BEAM_BUILD]
        found, score = np.take_along_axis(found, order, 1), np.take_along_axis(score, order, 1)
        picked = diverse(self.vectors, found, score, min(M, self.degree))
        self.neighbours[new, : picked.shape[1]] = picked
        # reverse links: each target's present and new neighbours, cut back where they are too many
        to, of = picked.ravel(), np.repeat(new, picked.shape[1])
        of, to = of[to >= 0], to[to >= 0]
        targets = np.unique(to)
        for i in range(0, len(targets), 1024):
            at = targets[i : i + 1024]
            mine = (to >= at[0]) & (to <= at[-1])
            present = self.neighbours[at]
            row, place = np.nonzero(present >= 0)
            row = np.r_[row, np.searchsorted(at, to[mine])]
            node = np.r_[present[present >= 0], of[mine]].astype(np.int64)
            row, node = np.unique(np.stack([row, node], 1), axis=0).T
            s = np.einsum("ij,ij->i", self.vectors[at[row]], self.vectors[node])
            order = np.lexsort((-s, row))
            row, node, s = row[order], node[order], s[order]
            k = np.arange(len(row)) - np.searchsorted(row, row)
            keep = k < 3 * self.degree
            width = int(k[keep].max()) + 1
            c, cs = np.full((len(at), width), -1, np.int64), np.full((len(at), width), -np.inf, np.float32)
            c[row[keep], k[keep]], cs[row[keep], k[keep]] = node[keep], s[keep]
            full = (c >= 0).sum(1) > self.degree
            kept = np.full((len(at), self.degree), -1, np.int64)
            kept[~full, : min(width, self.degree)] = c[~full, : self.degree]
            if full.any():
                kept[full] = diverse(self.vectors, c[full], cs[full], self.degree)
            self.neighbours[at] = kept


class Graph:
    """``vectors`` are distinct; ``ids`` of node i are ids[starts[i]:starts[i + 1]], ascending."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, starts: np.ndarray):
        self.vectors, self.ids, self.starts = vectors, ids, starts
        squares = (vectors**2).sum(1)
        extra = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
        self.flat = np.c_[vectors, extra].astype(np.float32)
        self.levels: list[Level] = []

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, keep: int, seed: int = 2) -> Graph:
        """Equal vectors become one node with its ``keep`` smallest ids: no more of them can be among the nearest."""
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        _, first, group = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        group = group.ravel()
        order = np.lexsort((ids, group))
        group, ids = group[order], ids[order]
        fresh = np.r_[True, (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])] if len(ids) else np.zeros(0, bool)
        group, ids = group[fresh], ids[fresh]
        ok = np.arange(len(group)) - np.searchsorted(group, group) < keep
        group, ids = group[ok], ids[ok]
        graph = cls(vectors[first], ids, np.searchsorted(group, np.arange(len(first) + 1)))
        n = len(first)
        rng = np.random.default_rng(seed)
        height = np.minimum((-np.log(1 - rng.random(n)) / np.log(M)).astype(int), 8)
        nodes = np.lexsort((rng.random(n), -height))  # the nodes of a level are the first of the next lower one
        for level in range(int(height.max(initial=0)), -1, -1):
            here = nodes[: int((height >= level).sum())]
            graph.levels.append(lv := Level(graph.flat, here, M if level else 2 * M))
            done = 0
            while done < len(here):
                size = min(len(here) - done, max(64, min(done, 1024)))
                step = _unit(len(here)) if done else size
                for at in range(done, done + size, step):
                    lv.insert(at, min(at + step, done + size), graph._entrance(len(graph.levels) - 1))
                done += size
        return graph

    def _entrance(self, level: int):
        """A function to the places where a search of ``level`` begins, found on the levels above it."""

        def down(x: np.ndarray) -> np.ndarray:
            at = np.zeros((len(x), 1), np.int64)
            for lv in self.levels[:level]:
                at = beam(lv.vectors, lv.neighbours, x, at, 8)[0][:, :4]
            return at  # a level's places are the same in the level below

        return down

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """The nodes found for each query, -1 for none."""
        x = np.c_[queries, np.zeros(len(queries))].astype(np.float32)
        lv = self.levels[-1]
        step = _unit(len(lv.nodes))
        parts = []
        for i in range(0, len(x), step):
            part = x[i : i + step]
            at = beam(lv.vectors, lv.neighbours, part, self._entrance(len(self.levels) - 1)(part), min(width, max(1, len(lv.nodes))))[0]
            parts.append(np.where(at >= 0, lv.nodes[at], -1))
        return np.concatenate(parts) if parts else np.zeros((0, width), np.int64)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, id, score) of at most ``k`` rows for each query, without the rows of its own id."""
        found = self.search(queries, width)
        out = []
        for i in range(0, len(found), 256):
            row, place = np.nonzero(found[i : i + 256] >= 0)
            node = found[i : i + 256][row, place]
            row = row + i
            score = (queries[row] * self.vectors[node]).sum(1)  # double precision
            n = self.starts[node + 1] - self.starts[node]
            at = np.repeat(self.starts[node] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            row, score, ids = np.repeat(row, n), np.repeat(score, n), self.ids[at]
            other = ids != query_ids[row]
            row, score, ids = row[other], score[other], ids[other]
            order = np.lexsort((ids, -score, row))
            row, score, ids = row[order], score[order], ids[order]
            top = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append((query_ids[row[top]], ids[top], score[top]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)

    def row(self, shard: int) -> dict:
        dump = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
        return {
            "shard": shard, "dim": self.vectors.shape[1], "n": len(self.vectors), "vectors": dump(self.vectors, "<f8"), "ids": dump(self.ids, "<i8"),
            "starts": dump(self.starts, "<i8"), "nodes": [dump(x.nodes, "<i4") for x in self.levels], "neighbours": [dump(x.neighbours, "<i4") for x in self.levels],
        }

    @classmethod
    def of_row(cls, row: dict) -> Graph:
        read = lambda x, kind: np.frombuffer(x, kind)
        graph = cls(read(row["vectors"], "<f8").reshape(row["n"], row["dim"]), read(row["ids"], "<i8"), read(row["starts"], "<i8"))
        for nodes, neighbours in zip(row["nodes"], row["neighbours"], strict=True):
            level = Level(graph.flat, read(nodes, "<i4").astype(np.int64), 1)
            level.neighbours = read(neighbours, "<i4").reshape(len(level.nodes), -1)
            graph.levels.append(level)
        return graph


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(-1, dim).astype(float) if len(column) else np.zeros((0, dim))


def usable(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector as doubles) of the rows that take part, and the dimension: the most frequent length."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    size = F.size("vector").alias("dim")
    common_dim = rows.groupBy(size).count().orderBy(F.desc("count"), "dim").first()
    dim = common_dim["dim"] if common_dim else 0
    return rows.where(F.size("vector") == dim), dim


def shards_for(n_rows: int, dim: int, most_bytes: int = MOST_BYTES) -> int:
    """The number of shards, which follows from the data alone."""
    rows = max(1, min(max(LEAST_ROWS, int(GROWTH * n_rows**0.5)), most_bytes // (8 * max(1, dim))))
    return max(1, -(-n_rows // rows))


def build_index(rows: DataFrame, dim: int, keep: int = K + 1, most_bytes: int = MOST_BYTES, n_rows: int | None = None) -> tuple[DataFrame, int]:
    """One row per shard with its graph (GRAPH), as a table in the shared folder, and the number of shards."""
    n_rows = rows.count() if n_rows is None else n_rows
    shards = shards_for(n_rows, dim, most_bytes)

    def build(key, table):
        graph = Graph.build(table.column("vec_id").to_numpy(), _matrix(table.column("vector"), dim), keep)
        row = graph.row(key[0].as_py())
        kinds = {"shard": pa.int32(), "dim": pa.int32(), "n": pa.int32(), "nodes": pa.list_(pa.binary()), "neighbours": pa.list_(pa.binary())}
        return pa.table({k: pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit("hnsw")), F.lit(shards)).cast("int"))
    return common.materialise(dealt.groupBy("shard").applyInArrow(build, GRAPH), "hnsw"), shards


def _searcher(queries, k: int, width: int):
    """A function from shards' graphs, one after the other, to what they find for the broadcast queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = Graph.of_row(batch.slice(i, 1).to_pylist()[0]).nearest(*queries.value, k, width)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    return search


def search_index(index: DataFrame, shards: int, queries: DataFrame, dim: int, k: int = K, width: int = BEAM_SEARCH, most_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row (vec_id, vector) of ``queries``.

    Every shard is searched for every query, in blocks of queries that are broadcast one after the other, where its graph
    is stored: graphs aren't shuffled. The shards' lists of ``k`` are merged block by block, so that no more than ``k`` rows
    of a query are kept.
    """
    spark = index.sparkSession
    queries = queries.select("vec_id", "vector").dropDuplicates(["vec_id"])
    blocks = max(1, -(-queries.count() * 8 * (dim + 1) // most_bytes))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    asked = common.materialise(queries.withColumn("block", block), "queries") if blocks > 1 else queries.withColumn("block", F.lit(0))
    best, found = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"), None
    for b in range(blocks):
        part = asked.where(F.col("block") == b).toArrow()  # about ``most_bytes``
        shared = spark.sparkContext.broadcast((part.column("vec_id").to_numpy(), _matrix(part.column("vector"), dim)))
        lists = index.mapInArrow(_searcher(shared, k, width), FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        here = common.materialise(lists, "found")
        shared.destroy()
        found = here if found is None else found.unionByName(here)
    return found.select("query_id", "rank", "vec_id", "score")


def search_table(table: DataFrame, every: int = 20, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", width: int = BEAM_SEARCH) -> DataFrame:
    """The ``k`` rows with the largest inner product for each row whose id is divisible by ``every``.

    query_id, rank (from 1), vec_id, score; ties go to the smaller id; a query's own id is no candidate. Vectors that
    are null or zero, hold a null or non-finite component or are not of the table's most frequent length take no part,
    nor do rows without an id. Rows that repeat an id and vector are one; of queries that repeat an id one is asked.
    With fewer candidates than ``k`` all of them are returned; an empty table gives an empty result.
    """
    rows, dim = usable(table, id_col, vector_col)
    index, shards = build_index(rows, dim, k + 1)
    return search_index(index, shards, rows.where(F.col("vec_id") % every == 0), dim, k, max(width, k + 1))
