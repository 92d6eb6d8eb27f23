"""Exact quantiles of several columns by histogram refinement.

A number's bits are mapped to an unsigned integer that grows with it. Each pass counts, for every rank that is asked for,
how many numbers have each value of the next DIGITS bits behind the bits known so far; after PASSES passes the number at the
rank is known to the last bit. A task holds counts only, at most 2**DIGITS for each rank, and what is shuffled are counts
too, so neither distinct values nor rows come together anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS, PASSES = 16, 4
_COUNTS = "col int, node int, digit int, n long"


def _ordered(x: np.ndarray, whole: bool) -> np.ndarray:
    """Unsigned integers in the order of the numbers; all NaN are one, the largest."""
    if whole:
        return x.view(np.uint64) ^ np.uint64(1 << 63)
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def _number(key: int, whole: bool) -> float | int:
    if whole:
        return int(np.array([key ^ (1 << 63)], np.uint64).view(np.int64)[0])
    bits = key & ~(1 << 63) if key >> 63 else ~key & (2**64 - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _counted(whole: list[bool], known: list[np.ndarray], level: int):
    """A task's counts of the next digit, behind each of the ``known`` beginnings of a column."""
    shift = np.uint64(64 - DIGITS * (level + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros((len(k), 1 << DIGITS), np.int64) for k in known]
        for batch in batches:
            for c, beginnings in enumerate(known):
                column = batch.column(c).drop_null()
                if not len(column) or not len(beginnings):
                    continue
                key = _ordered(column.to_numpy(zero_copy_only=False), whole[c]) >> shift
                begin = key >> np.uint64(DIGITS) if level else np.zeros(len(key), np.uint64)
                at = np.minimum(np.searchsorted(beginnings, begin), len(beginnings) - 1)
                mine = beginnings[at] == begin
                digit = (key[mine] & np.uint64((1 << DIGITS) - 1)).astype(np.int64)
                counts[c] += np.bincount(at[mine] << DIGITS | digit, minlength=counts[c].size).reshape(counts[c].shape)
        for c, table in enumerate(counts):
            node, digit = np.nonzero(table)
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), c), pa.int32()), pa.array(node, pa.int32()), pa.array(digit, pa.int32()), pa.array(table[node, digit])], names=["col", "node", "digit", "n"])

    return run


def numbers_at(df: DataFrame, columns: list[str], ranks) -> list[dict[int, float]]:
    """For each column the numbers at some ranks (from 0) of its ascending values that aren't null.

    ``ranks`` gives them for a column's count of values. Whole numbers are compared as such, others in double precision.
    """
    whole = [df.schema[c].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") for c in columns]
    rows = df.select(*[F.col(c).cast("bigint" if w else "double").alias(f"c{i}") for i, (c, w) in enumerate(zip(columns, whole, strict=True))])
    known = [np.zeros(1, np.uint64) for _ in columns]
    open_: list[dict[int, tuple[int, int]]] = [{} for _ in columns]  # rank -> (bits known so far, rank among what begins so)
    for level in range(PASSES):
        found = rows.mapInArrow(_counted(whole, known, level), _COUNTS).groupBy("col", "node", "digit").agg(F.sum("n").alias("n")).toArrow()  # at most 2**DIGITS for each rank
        col, node, digit, n = (found.column(x).to_numpy() for x in ("col", "node", "digit", "n"))
        after = []
        for c in range(len(columns)):
            at = np.flatnonzero(col == c)
            at = at[np.lexsort((digit[at], node[at]))]
            if not level:
                open_[c] = {r: (0, r) for r in ranks(int(n[at].sum()))}
            for r, (begin, left) in open_[c].items():
                mine = at[node[at] == np.searchsorted(known[c], np.uint64(begin))]
                ends = np.cumsum(n[mine])
                i = int(np.searchsorted(ends, left, "right"))
                open_[c][r] = begin << DIGITS | int(digit[mine[i]]), left - int(ends[i] - n[mine[i]])
            after.append(np.unique(np.array([b for b, _ in open_[c].values()], np.uint64)))
        known = after
    return [{r: _number(begin, w) for r, (begin, _) in of.items()} for of, w in zip(open_, whole, strict=True)]


def quantiles(df: DataFrame, columns: list[str], at: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A row for each column: column, rows (values that aren't null), min, a column p.. for each of ``at`` (between
    neighbours it is interpolated), max. Nulls don't count, NaN is larger than all numbers; no values give nulls."""
    if any(not 0 <= p <= 1 for p in at):
        raise ValueError("quantiles are from 0 to 1")
    sizes = {}

    def ranks(n: int) -> set[int]:
        wanted = {0, n - 1} | {r for p in at for r in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1))} if n else set()
        sizes[len(sizes)] = n
        return wanted

    out = []
    for i, (name, found) in enumerate(zip(columns, numbers_at(df, columns, ranks), strict=True)):
        n = sizes[i]
        row = [name, n, float(found[0]) if n else None]
        for p in at:
            low = int(p * (n - 1)) if n else 0
            a, b = (float(found[low]), float(found[min(low + 1, n - 1)])) if n else (None, None)
            part = p * (n - 1) - low
            row.append((a if a == b or not part else a + (b - a) * part) if n else None)
        out.append((*row, float(found[n - 1]) if n else None))
    return df.sparkSession.createDataFrame(out, "column string, rows long, min double, " + ", ".join(f"p{round(100 * p, 4):g} double".replace(".", "_") for p in at) + ", max double")
