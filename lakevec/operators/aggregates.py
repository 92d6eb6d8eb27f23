"""Aggregates of one's own with a buffer that can be merged: partial results per task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys whose buffers a task holds at once; when there are more they are given out and begun anew.
HELD = 100_000


class Mergeable(Protocol):
    """A buffer is a short row of doubles, the same number for every key."""

    def zero(self) -> np.ndarray: ...

    def update(self, buffers: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
        """Add ``values`` to the buffers (rows) that ``at`` names."""

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray: ...

    def finish(self, buffers: np.ndarray) -> np.ndarray: ...


class Moments:
    """Count, mean and sums of powers of differences from it: ``finish`` gives the skewness. Merged by Chan's formulas, so
    nothing is lost to cancellation, in whatever order tasks end."""

    def zero(self) -> np.ndarray:
        return np.zeros(4)

    def update(self, buffers, at, values) -> None:
        order = np.argsort(at, kind="stable")
        groups, start = np.unique(at[order], return_index=True)
        v = values[order]
        n = np.diff(np.append(start, len(v))).astype(float)
        mean = np.add.reduceat(v, start) / n
        d = v - np.repeat(mean, n.astype(int))
        part = np.stack([n, mean, np.add.reduceat(d**2, start), np.add.reduceat(d**3, start)], 1)
        buffers[groups] = self.merge(buffers[groups], part)

    def merge(self, a, b) -> np.ndarray:
        na, nb = a[..., 0], b[..., 0]
        n = na + nb
        safe = np.where(n > 0, n, 1)
        d = b[..., 1] - a[..., 1]
        m2 = a[..., 2] + b[..., 2] + d**2 * na * nb / safe
        m3 = a[..., 3] + b[..., 3] + d**3 * na * nb * (na - nb) / safe**2 + 3 * d * (na * b[..., 2] - nb * a[..., 2]) / safe
        return np.stack([n, np.where(n > 0, (na * a[..., 1] + nb * b[..., 1]) / safe, 0), m2, m3], -1)

    def finish(self, buffers) -> np.ndarray:
        n, _, m2, m3 = buffers.T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((n > 0) & (m2 > 0), np.sqrt(n) * m3 / m2**1.5, np.nan)


def _partial(by: list[str], value: str, how: Mergeable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, int] = {}
        buffers = np.zeros((0, len(how.zero())))

        def give() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in known], kinds[i]) for i in range(len(by))]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(known) + 1) * buffers.shape[1], pa.int32()), pa.array(buffers[: len(known)].ravel()))
            return pa.RecordBatch.from_arrays([*columns, lists], names=[*by, "_buffer"])

        kinds = None
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(value)))
            kinds = [batch.column(c).type for c in by]
            if not batch.num_rows:
                continue
            keys = list(zip(*[batch.column(c).to_pylist() for c in by], strict=True))
            at = np.fromiter((known.setdefault(k, len(known)) for k in keys), np.int64, len(keys))
            if len(known) > len(buffers):
                buffers = np.concatenate([buffers, np.tile(how.zero(), (len(known), 1))])
            how.update(buffers, at, batch.column(value).to_numpy(zero_copy_only=False))
            if len(known) > HELD:
                yield give()
                known, buffers = {}, buffers[:0]
        if known:
            yield give()

    return run


def aggregate(df: DataFrame, by: list[str], value: str, how: Mergeable, out: str) -> DataFrame:
    """``by`` and ``out``: the aggregate of ``value`` (as a double; nulls don't count) for each key that has a value.

    Each task gives one buffer a key, which are merged by key in a stream of sorted buffers, so a key with most rows is as
    many buffers as tasks. Null keys are one key."""
    rows = df.select(*by, F.col(value).cast("double").alias(value))
    key = [rows.schema[c] for c in by]
    buffers = rows.mapInArrow(_partial(by, value, how), T.StructType([*key, T.StructField("_buffer", T.ArrayType(T.DoubleType()))]))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done = None, None, []

        def give() -> pa.RecordBatch:
            results = how.finish(np.stack([b for _, b in done]))
            return pa.RecordBatch.from_arrays([*[pa.array([k[i] for k, _ in done], kinds[i]) for i in range(len(by))], pa.array(results, pa.float64(), from_pandas=True)], names=[*by, out])

        kinds = None
        for batch in batches:
            kinds = [batch.column(c).type for c in by]
            for *k, buffer in zip(*[batch.column(c).to_pylist() for c in by], batch.column("_buffer").to_pylist(), strict=True):
                if held is not None and k == now:
                    held = how.merge(held, np.array(buffer))
                    continue
                if held is not None:
                    done.append((now, held))
                    if len(done) >= 10_000:
                        yield give()
                        done = []
                now, held = k, np.array(buffer)
        if held is not None:
            done.append((now, held))
            yield give()

    return buffers.repartition(*by).sortWithinPartitions(*by).mapInArrow(merged, T.StructType([*key, T.StructField(out, T.DoubleType())]))
