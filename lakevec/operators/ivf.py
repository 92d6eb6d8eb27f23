"""Inverted-file vector index: rows stored by the cell of their nearest centre, of which a search opens a few.

Centres come from k-means over a bounded, documented sample; all rows are indexed. A cell is a folder, so cells that aren't
probed are partitions that Spark prunes. What a search finds is scored again exactly, in double precision. With the radius
of every cell a search can also be exact: cells that cannot hold a nearer row than the k-th found so far stay shut, the rest
is opened in a second pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions import distance
from . import topk

#: Cells at most, sampled rows for each cell, rounds of k-means, rows of a cell in one file.
CELLS, SAMPLED, ROUNDS, ROWS_PER_FILE = 4096, 64, 6, 1_000_000
METRICS = ("L2", "IP", "COSINE")
#: The recall that a search without a stated number of probes aims at, and the queries it is measured with.
RECALL, ASKED = 0.95, 100


@dataclass(frozen=True)
class Cells:
    """Centres (a matrix), the largest distance of a row from its centre and the rows, for each cell. ``longest`` is the
    length of the longest vector: for IP, vectors get one more component that makes all of them equally long, which turns
    the largest product into the smallest distance."""

    metric: str
    dim: int
    longest: float
    centres: np.ndarray = field(repr=False)
    radius: np.ndarray = field(repr=False)
    rows: np.ndarray = field(repr=False)

    def placed(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors in the space whose distances rank as the metric does; zero vectors stay zero."""
        if self.metric == "COSINE":
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            return x / np.where(norm > 0, norm, 1)
        if self.metric == "IP":
            more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x**2).sum(1), 0))
            return np.c_[x, more]
        return x

    def distances(self, queries: np.ndarray) -> np.ndarray:
        q = self.placed(queries, True)
        return np.sqrt(np.maximum((q**2).sum(1)[:, None] - 2 * q @ self.centres.T + (self.centres**2).sum(1)[None, :], 0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance from its centre) of rows."""
        p = self.placed(x)
        d = (p**2).sum(1)[:, None] - 2 * p @ self.centres.T + (self.centres**2).sum(1)[None, :]
        at = d.argmin(1)
        return at, np.sqrt(((p - self.centres[at]) ** 2).sum(1))

    def reach(self, query: np.ndarray, score: float) -> float:
        """The distance, in the space of the centres, of a row with this score from the query."""
        q = self.placed(query[None, :], True)[0]
        if self.metric == "L2":
            return score
        length = self.longest**2 if self.metric == "IP" else 1.0
        return math.sqrt(max((q**2).sum() + length - 2 * score, 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(float)


def _vectors(rows: DataFrame, vector_col: str, dim: int, metric: str) -> DataFrame:
    v = F.col(vector_col)
    usable = rows.where((F.size(v) == dim) & topk.finite(v))
    return usable.where(F.exists(v, lambda x: x != 0)) if metric == "COSINE" else usable


def _rounds(sample: DataFrame, cells: Cells, rounds: int) -> Cells:
    spark, width = sample.sparkSession, cells.centres.shape[1]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(cells)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            c = shared.value
            n, total = np.zeros(len(c.centres), np.int64), np.zeros((len(c.centres), width))
            for batch in batches:
                x = _matrix(batch.column("v"), c.dim)
                at = c.nearest(x)[0]
                n += np.bincount(at, minlength=len(n))
                np.add.at(total, at, c.placed(x))
            used = np.flatnonzero(n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(total[used].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), lists], names=["cell", "n", "total"])

        found = sample.mapInArrow(sums, "cell long, n long, total array<double>").groupBy("cell")
        table = found.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[j]) for j in range(width)]).alias("total")).toArrow()  # a row for each cell
        shared.destroy()
        centres = cells.centres.copy()
        centres[table.column("cell").to_numpy()] = np.array(table.column("total").to_pylist(), float).reshape(-1, width) / table.column("n").to_numpy()[:, None]
        cells = Cells(cells.metric, cells.dim, cells.longest, centres, cells.radius, cells.rows)
    return cells


def train(rows: DataFrame, vector_col: str, id_col: str, dim: int, metric: str, cells: int | None = None, rounds: int = ROUNDS) -> Cells:
    """Centres from k-means over at most about SAMPLED rows for each cell, those with the smallest hashes of their id; the
    square root of the number of rows is the number of cells unless it is given."""
    usable = _vectors(rows, vector_col, dim, metric)
    n, longest = usable.agg(F.count("*"), F.coalesce(F.max(distance.norm(F.col(vector_col))), F.lit(0.0))).first()
    cells = max(1, min(n, CELLS, cells or math.isqrt(n)))
    empty = Cells(metric, dim, longest, np.zeros((0, dim + (metric == "IP"))), np.zeros(0), np.zeros(0, np.int64))
    if not n:
        return empty
    share = min(1.0, SAMPLED * cells / n)
    mark = F.xxhash64(F.col(id_col).cast("string"))
    sample = usable.where(mark <= int((2 * share - 1) * (2**63 - 1))) if share < 1 else usable
    sample = storage.materialise(sample.select(F.col(vector_col).cast("array<double>").alias("v"), mark.alias("mark")), "sample")
    first = sample.groupBy("v").agg(F.min("mark").alias("mark")).orderBy("mark").limit(cells).select("v").toArrow()  # a row for each cell
    start = empty.placed(np.array(first.column("v").to_pylist(), float).reshape(len(first), dim))
    return _rounds(sample.select("v"), Cells(metric, dim, longest, start, np.zeros(len(start)), np.zeros(len(start), np.int64)), rounds)


def write(rows: DataFrame, vector_col: str, cells: Cells, path: str) -> Cells:
    """Store ``rows`` (all columns) by cell below ``path``; the cells with their radius and rows.

    Large cells become several files; no task gets more than about ROWS_PER_FILE rows of a cell."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(cells)
    kept = _vectors(rows, vector_col, cells.dim, cells.metric)
    out = T.StructType([*kept.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_from_centre", T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, far = shared.value.nearest(_matrix(batch.column(vector_col), cells.dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32()), pa.array(far)], names=[*batch.schema.names, "_cell", "_from_centre"])

    placed = storage.materialise(kept.mapInArrow(assign, out), "placed")
    known = placed.groupBy("_cell").agg(F.max("_from_centre").alias("radius"), F.count("*").alias("n")).collect()  # a row for each cell
    radius, count = np.zeros(len(cells.centres)), np.zeros(len(cells.centres), np.int64)
    for r in known:
        radius[r["_cell"]], count[r["_cell"]] = r["radius"], r["n"]
    parts = spark.createDataFrame([(r["_cell"], -(-r["n"] // ROWS_PER_FILE)) for r in known], "_cell int, _parts long")
    dealt = placed.join(F.broadcast(parts), "_cell").withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.col("_parts")))
    dealt.repartition("_cell", "_part").drop("_part", "_parts").write.mode("overwrite").partitionBy("_cell").parquet(path)
    return Cells(cells.metric, cells.dim, cells.longest, cells.centres, radius, count)


def save_cells(spark: SparkSession, cells: Cells, path: str) -> None:
    rows = [(i, c.tolist(), float(r), int(n)) for i, (c, r, n) in enumerate(zip(cells.centres, cells.radius, cells.rows, strict=True))]
    spark.createDataFrame(rows, "cell int, centre array<double>, radius double, n long").coalesce(1).write.mode("overwrite").parquet(path)


def load_cells(spark: SparkSession, path: str, metric: str, dim: int, longest: float) -> Cells:
    """A row for each cell, at most CELLS."""
    rows = spark.read.parquet(path).orderBy("cell").toArrow()
    centres = np.array(rows.column("centre").to_pylist(), float).reshape(len(rows), dim + (metric == "IP"))
    return Cells(metric, dim, longest, centres, rows.column("radius").to_numpy(), rows.column("n").to_numpy())


def calibrate(stored: DataFrame, cells: Cells, id_col: str, vector_col: str, recall: float = RECALL, k: int = 10) -> int:
    """How many of the nearest cells a search must open for ``recall`` of the exact ``k`` nearest, on average over ASKED of
    the rows (smallest hashes) as queries: one exact pass, then the places of the neighbours' cells in each query's order."""
    mark = F.xxhash64(F.col(id_col).cast("string"))
    rows = stored.select(mark.alias("id"), F.col(vector_col).alias("v"), "_cell")
    queries = storage.materialise(rows.orderBy(F.xxhash64("id")).limit(ASKED).select("id", "v"), "asked")
    near = topk.batch_top_k(rows, queries, k, cells.metric, "id", "v", exclude_self=True)
    pairs = near.join(rows.select("id", "_cell").groupBy("id").agg(F.min("_cell").alias("_cell")), "id").select("query_id", "_cell").collect()  # ASKED * k rows
    asked = queries.collect()
    if not pairs:
        return len(cells.centres)
    order = np.argsort(np.argsort(cells.distances(np.array([r["v"] for r in asked], float)), axis=1, kind="stable"), axis=1)
    at = {r["id"]: i for i, r in enumerate(asked)}
    places = np.sort([order[at[r["query_id"]], r["_cell"]] for r in pairs])
    return int(places[min(len(places) - 1, math.ceil(recall * len(places)) - 1)]) + 1


def search(stored: DataFrame, cells: Cells, query: list[float], k: int, id_col: str, vector_col: str, probes: int, where: Column | None = None, output: list[str] | None = None, exact: bool = False, also: DataFrame | None = None) -> DataFrame:
    """The ``k`` nearest of the ``probes`` nearest cells (and of ``also``, rows that no cell has), scored exactly.

    ``exact`` opens further cells as long as they may hold a nearer row: the distance of a cell's centre less its radius
    must not be over that of the k-th row found. Rows that only tie with the k-th are found too."""
    asked = np.array([query], float)
    if asked.shape[1] != cells.dim or not np.isfinite(asked).all():
        raise ValueError(f"a query needs {cells.dim} finite components")
    far = cells.distances(asked)[0]
    near = np.argsort(far, kind="stable")

    def opened(which: np.ndarray) -> DataFrame:
        rows = stored.where(F.col("_cell").isin(which.tolist())).drop("_cell", "_from_centre")
        return rows if also is None else rows.unionByName(also.select(*rows.columns))

    first = near[: max(1, probes)]
    found = topk.top_k(opened(first), query, k, cells.metric, id_col, vector_col, where, output)
    if not exact or len(first) == len(near):
        return found
    best = found.select("score").collect()  # k rows
    limit = math.inf if len(best) < k else cells.reach(asked[0], (max if cells.metric == "L2" else min)(r["score"] for r in best))
    slack = 1e-9 * (1 + abs(limit) + float(np.abs(far).max(initial=0)))  # what rounding may do to a bound
    more = np.flatnonzero((far - cells.radius <= limit + slack) & (cells.rows > 0))
    return topk.top_k(opened(np.union1d(first, more)), query, k, cells.metric, id_col, vector_col, where, output)


def search_batch(stored: DataFrame, cells: Cells, queries: DataFrame, k: int, id_col: str, vector_col: str, probes: int, exclude_self: bool = False) -> DataFrame:
    """query_id, rank, id, score of the ``k`` nearest rows in the ``probes`` nearest cells of every query.

    Queries are broadcast in blocks of topk.BROADCAST_BYTES; only cells that some query of a block probes are opened, and a
    cell's rows are compared with the queries that probe it."""
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where((F.size("v") == cells.dim) & topk.finite(F.col("v")))
    if cells.metric == "COSINE":
        asked = asked.where(F.exists("v", lambda x: x != 0))
    n = asked.count()
    blocks = max(1, -(-n * 8 * max(1, cells.dim) // topk.BROADCAST_BYTES))
    larger, found = distance.nearer_is_larger(cells.metric), None
    data = stored.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), "_cell")
    for b in range(blocks):
        table = (asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else asked).toArrow()  # about BROADCAST_BYTES
        ids, matrix = table.column("id").to_numpy(), np.array(table.column("v").to_pylist(), float).reshape(len(table), cells.dim)
        near = np.argsort(cells.distances(matrix), axis=1, kind="stable")[:, : max(1, probes)]
        shared = stored.sparkSession.sparkContext.broadcast((ids, matrix, near))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, matrix, near = shared.value
            probing = {c: np.flatnonzero((near == c).any(1)) for c in np.unique(near).tolist()}
            kept, size = [], 0
            for batch in batches:
                x, row_ids, cell = _matrix(batch.column("v"), cells.dim), batch.column("id").to_numpy(), batch.column("_cell").to_numpy()
                for c in np.unique(cell).tolist():
                    mine = np.flatnonzero(cell == c)
                    q = probing.get(c, np.zeros(0, np.int64))
                    for i in range(0, len(q), max(1, topk.SCORES // max(1, len(mine) * cells.dim))):
                        some = q[i : i + max(1, topk.SCORES // max(1, len(mine) * cells.dim))]
                        s = np.stack([topk._exact(cells.metric, matrix[j][None, :], x[mine]) for j in some])
                        if exclude_self:
                            s[ids[some][:, None] == row_ids[mine][None, :]] = -np.inf if larger else np.inf
                        at, of = np.nonzero(np.isfinite(s))
                        kept.append((some[at], row_ids[mine[of]], s[at, of]))
                        size += len(at)
                        if size > 4 * k * len(ids) + 100_000:
                            kept = [topk._best(kept, k, larger)]
                            size = len(kept[0][0])
            if kept:
                q, r, s = topk._best(kept, k, larger)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(r), pa.array(s)], names=["query_id", "id", "score"])

        part = data.where(F.col("_cell").isin(np.unique(near).tolist())).mapInArrow(run, "query_id long, id long, score double")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if larger else F.asc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def described(cells: Cells) -> dict:
    return {k: v for k, v in asdict(cells).items() if k in ("metric", "dim", "longest")}
