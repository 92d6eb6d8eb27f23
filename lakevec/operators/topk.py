"""Exact top-k similarity search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import distance

#: Bytes of query vectors that are broadcast at once; more are asked in blocks of this size.
BROADCAST_BYTES = 32 << 20
#: Scores, and numbers of vectors that are scored again, that a task holds at once.
SCORES = 2 << 20


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite components; others take no part in a search."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def top_k(rows: DataFrame, query: list[float] | bytes, k: int, metric: str = "L2", id_col: str = "id", vector_col: str = "vector", where: Column | None = None, output: list[str] | None = None) -> DataFrame:
    """The ``k`` nearest rows, nearest first, ties to the smaller id: each task keeps ``k`` rows, no shuffle of vectors.

    HAMMING takes bytes on both sides, the other metrics lists of numbers. Vectors with a null or non-finite component, or
    of another length than the query, take no part."""
    if where is not None:
        rows = rows.where(where)
    vector = F.col(vector_col)
    if metric.upper() == "HAMMING":
        asked, usable = F.lit(bytes(query)), F.octet_length(vector) == len(query)
    else:
        asked, usable = F.array(*[F.lit(float(x)) for x in query]), (F.size(vector) == len(query)) & finite(vector)
    rows = rows.where(usable).withColumn("score", distance.score(metric, vector, asked))
    order = F.desc("score") if distance.nearer_is_larger(metric) else F.asc("score")
    return rows.where("score IS NOT NULL").orderBy(order, id_col).limit(k).select(id_col, "score", *(output or []))


def _scores(metric: str, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores that rank as the metric does, larger first."""
    if metric == "L2":
        return -((rows**2).sum(1)[None, :] - 2 * queries @ rows.T + (queries**2).sum(1)[:, None])
    out = queries @ rows.T
    if metric == "COSINE":
        with np.errstate(divide="ignore", invalid="ignore"):
            out = out / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :])
    return out


def _errors(metric: str, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bounds on what rounding does to ``_scores``, and to ``_exact`` on that scale."""
    a, b = np.linalg.norm(queries, axis=1)[:, None], np.linalg.norm(rows, axis=1)[None, :]
    unit = 8 * (rows.shape[1] + 8) * np.finfo(float).eps
    return unit * ((a + b) ** 2 if metric == "L2" else a * b if metric == "IP" else np.ones((len(a), b.shape[1]))) + np.finfo(float).tiny


def _exact(metric: str, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    if metric == "L2":
        return np.sqrt(((query - row) ** 2).sum(1))
    out = (query * row).sum(1)
    if metric == "COSINE":
        out = out / (np.sqrt((query**2).sum(1)) * np.sqrt((row**2).sum(1)))
    return out


def batch_top_k(rows: DataFrame, queries: DataFrame, k: int, metric: str = "L2", id_col: str = "id", vector_col: str = "vector", exclude_self: bool = False) -> DataFrame:
    """query_id, rank, id, score of the ``k`` nearest rows of every query.

    Queries are broadcast as a matrix, in blocks of BROADCAST_BYTES; a task keeps ``k`` rows for each query over all its
    batches, so what is shuffled doesn't grow with the rows. However many rows tie, the smaller ids come first. Vectors that are null or have null or non-finite components, and zero
    ones for COSINE, take no part, nor do rows of another length than the queries. ValueError if queries differ in length.
    """
    metric = metric.upper()
    if metric not in ("L2", "IP", "COSINE"):
        raise ValueError(f"no batched search by {metric}")
    larger = distance.nearer_is_larger(metric)
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(finite(F.col("v")))
    if metric == "COSINE":
        asked = asked.where(F.exists("v", lambda x: x != 0))
    n, dim, least = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.min(F.size("v")), F.lit(0))).first()
    if least != dim:
        raise ValueError(f"queries have {least} to {dim} components; ask those of one length at once")
    per_block = max(1, BROADCAST_BYTES // (8 * max(1, dim)))
    blocks = -(-n // per_block)
    data = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where((F.size("v") == dim) & finite(F.col("v")))
    found = None
    for b in range(max(1, blocks)):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else asked
        table = mine.toArrow()  # about BROADCAST_BYTES
        ids = table.column("id").to_numpy()
        matrix = np.array(table.column("v").to_pylist(), float).reshape(len(ids), dim)
        shared = rows.sparkSession.sparkContext.broadcast((ids, matrix))
        part = data.mapInArrow(_searcher(shared, k, metric, larger, exclude_self, dim), "query_id long, id long, score double")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if larger else F.asc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _searcher(shared, k: int, metric: str, larger: bool, exclude_self: bool, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        kept, n = [], 0  # (query, id, score), and how many
        for batch in batches:
            row_ids = batch.column("id").to_numpy()
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            block = max(1, SCORES // max(1, len(x)))
            for i in range(0, len(ids), block):
                part = slice(i, i + block)
                s = _scores(metric, queries[part], x)
                if exclude_self:
                    s[ids[part][:, None] == row_ids[None, :]] = -np.inf
                s = np.where(np.isnan(s), -np.inf, s)
                q, c = np.nonzero(_nearest(s, _errors(metric, queries[part], x), k))
                for j in range(0, len(q), max(1, SCORES // max(1, dim))):
                    at = slice(j, j + max(1, SCORES // max(1, dim)))
                    kept.append((q[at] + i, row_ids[c[at]], _exact(metric, queries[q[at] + i], x[c[at]])))
                    n += len(kept[-1][0])
                    if n > 4 * k * len(ids) + 100_000:
                        kept = [_best(kept, k, larger)]
                        n = len(kept[0][0])
        if kept:
            q, r, s = _best(kept, k, larger)
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(r), pa.array(s)], names=["query_id", "id", "score"])

    return run


def _nearest(s: np.ndarray, errors: np.ndarray, k: int) -> np.ndarray:
    """Where a score, as far as rounding lets it be known, is among the ``k`` best of its line: all ties are."""
    found = np.isfinite(s)
    if 0 < k < s.shape[1]:
        least = np.where(found, s - errors, -np.inf)
        found &= s + errors >= np.partition(least, s.shape[1] - k, 1)[:, s.shape[1] - k, None]
    return found


def _best(kept, k: int, larger: bool):
    q, r, s = (np.concatenate(p) for p in zip(*kept, strict=True))
    order = np.lexsort((r, -s if larger else s, q))
    q, r, s = q[order], r[order], s[order]
    top = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[top], r[top], s[top]


def sparse_top_k(rows: DataFrame, query: dict[int, float], k: int, id_col: str = "id", vector_col: str = "vector") -> DataFrame:
    """The ``k`` rows (maps from index to value) with the largest inner product; rows that share no index have none."""
    q = F.create_map(*[F.lit(x) for i, v in sorted(query.items()) for x in (int(i), float(v))]) if query else F.create_map().cast("map<bigint,double>")
    q = q.cast("map<bigint,double>")
    vector = F.col(vector_col)
    rows = rows.where(F.arrays_overlap(F.map_keys(vector), F.map_keys(q)))
    return rows.withColumn("score", distance.sparse_inner_product(vector, q)).orderBy(F.desc("score"), id_col).limit(k).select(id_col, "score")
