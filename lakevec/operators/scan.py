"""Windows over hot keys: a segmented scan.

Rows are dealt by ranges of key and order, so that a key with most rows lies in many ranges, and each range is scanned by
itself in a stream. What a range's last key has come to (rows, sum, rank, last value) is one row a range; these are carried
from range to range, and a range's first key is moved up by what came before it. No task gets a key as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from .asof import asof_join

_LEAST = -(1 << 63)
#: Columns that a scan adds for itself.
_OWN = ("_order", "_value", "_part", "_at", "_first")
ADDED = ("row_number", "rank", "dense_rank", "running_sum", "previous")


def _changes(batch: pa.RecordBatch, columns: list[str], last: pa.RecordBatch | None) -> np.ndarray:
    """Where a row differs from the one before in some of the columns; nulls are equal."""
    out = np.zeros(batch.num_rows, bool)
    for c in columns:
        now = batch.column(c)
        before = pa.concat_arrays([last.column(c) if last is not None else now.slice(0, 1), now.slice(0, len(now) - 1)])
        same = pc.if_else(pc.or_(pc.is_null(now), pc.is_null(before)), pc.and_(pc.is_null(now), pc.is_null(before)), pc.equal(now, before))
        out |= ~same.to_numpy(zero_copy_only=False)
    if last is None and len(out):
        out[0] = True
    return out


def _scanned(by: list[str], whole: bool):
    """A range's own windows; the state at the end of a batch goes on with the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, rank, dense, total = None, 0, 0, 0, 0
        previous = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.arange(batch.num_rows)
            fresh = _changes(batch, by, last)
            tie = fresh | _changes(batch, ["_order"], last)
            start = np.maximum.accumulate(np.where(fresh, at, -1))  # -1: a key that the batch before had already
            number = np.where(start >= 0, at - start + 1, at + 1 + n)
            first = np.maximum.accumulate(np.where(tie, at, -1))
            ranks = np.where(first >= 0, number[np.maximum(first, 0)], rank)
            steps = np.cumsum(tie)
            denses = np.where(start >= 0, steps - np.where(start > 0, steps[np.maximum(start - 1, 0)], 0), steps + dense)
            value = batch.column("_value")
            known = pc.fill_null(value, 0).to_numpy(zero_copy_only=False)
            sums = np.cumsum(known, dtype=np.int64 if whole else float)
            sums = np.where(start >= 0, sums - np.where(start > 0, sums[np.maximum(start - 1, 0)], 0), sums + total)
            before = pa.concat_arrays([pa.array([previous], value.type), value.slice(0, len(value) - 1)])
            before = pc.if_else(pa.array(fresh), pa.scalar(None, value.type), before)
            last, n, rank, dense, total, previous = batch.slice(batch.num_rows - 1), int(number[-1]), int(ranks[-1]), int(denses[-1]), sums[-1], value[-1].as_py()
            added = [pa.array(number, pa.int64()), pa.array(ranks, pa.int64()), pa.array(denses, pa.int64()), pa.array(sums), before]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *[f"_{a}" for a in ADDED]])

    return run


def scan(df: DataFrame, by: list[str], order: str, value: str, tie: list[str] | None = None) -> DataFrame:
    """``df`` with row_number, rank, dense_rank, running_sum and previous of each row within ``by``, in the order of ``order``
    (nulls first), which ranks count by, and then of ``tie``.

    ``value`` is summed up to and with the row (nulls count as 0; whole numbers exactly, others in double precision) and
    taken from the row before. Null keys are one key. Rows that are equal in all of these are numbered in any order.
    """
    clash = {*ADDED, *_OWN} & set(df.columns)
    if clash:
        raise ValueError(f"there is a column {sorted(clash)[0]} already")
    whole = df.schema[value].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    kind = T.LongType() if whole else T.DoubleType()
    rows = df.withColumns({"_order": F.col(order), "_value": F.col(value).cast(kind)})
    keys = [F.col(c).asc_nulls_first() for c in (*by, "_order", *(tie or []))]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = T.StructType([*dealt.schema.fields, *[T.StructField(f"_{a}", T.LongType()) for a in ADDED[:3]], *[T.StructField(f"_{a}", kind) for a in ADDED[3:]]])
    kept = storage.materialise(dealt.mapInArrow(_scanned(by, whole), out).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "scan")

    key = F.struct(*[F.col(c) for c in by])
    state = F.struct(key.alias("key"), F.col("_order").alias("order"), *[F.col(f"_{a}").alias(a) for a in ADDED[:4]], F.col("_value").alias("value"))
    ends = kept.groupBy("_part").agg(F.min_by(F.struct(key.alias("key"), F.col("_order").alias("order")), "_at").alias("first"), F.max_by(state, "_at").alias("last")).orderBy("_part").collect()  # a row for each range
    carried, now = [], None  # now: what the last key of all ranges so far has come to
    for e in ends:
        first, last = e["first"], e["last"]
        goes_on = now is not None and first["key"] == now["key"]
        if goes_on:
            carried.append((e["_part"], now["row_number"], now["rank"], now["dense_rank"], now["running_sum"], now["value"], first["order"] == now["order"]))
        mine = last.asDict()
        if goes_on and last["key"] == first["key"]:
            meets = first["order"] == now["order"]
            in_tie = meets and last["dense_rank"] == 1
            mine["rank"] = now["rank"] if in_tie else last["rank"] + now["row_number"]
            mine["dense_rank"] = last["dense_rank"] + now["dense_rank"] - meets
            mine["row_number"], mine["running_sum"] = last["row_number"] + now["row_number"], last["running_sum"] + now["running_sum"]
        now = mine
    of = kind.simpleString()
    state_type = f"_part int, _c_number long, _c_rank long, _c_dense long, _c_sum {of}, _c_value {of}, _c_meets boolean"
    moves = df.sparkSession.createDataFrame(carried, state_type)
    heads = df.sparkSession.createDataFrame([(e["_part"], e["first"]["key"]) for e in ends], T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_first", T.StructType([df.schema[c] for c in by]))]))
    both = kept.join(F.broadcast(moves.join(heads, "_part")), "_part", "left")
    mine = F.coalesce(key.eqNullSafe(F.col("_first")), F.lit(False)) & F.col("_c_number").isNotNull()
    in_tie = mine & F.col("_c_meets") & (F.col("_dense_rank") == 1)
    moved = {
        "row_number": F.when(mine, F.col("_row_number") + F.col("_c_number")).otherwise(F.col("_row_number")),
        "rank": F.when(in_tie, F.col("_c_rank")).when(mine, F.col("_rank") + F.col("_c_number")).otherwise(F.col("_rank")),
        "dense_rank": F.when(mine, F.col("_dense_rank") + F.col("_c_dense") - F.col("_c_meets").cast("int")).otherwise(F.col("_dense_rank")),
        "running_sum": F.when(mine, F.col("_running_sum") + F.col("_c_sum")).otherwise(F.col("_running_sum")),
        "previous": F.when(mine & (F.col("_row_number") == 1), F.col("_c_value")).otherwise(F.col("_previous")),
    }
    return both.select(*df.columns, *[c.alias(n) for n, c in moved.items()])


def range_frame(df: DataFrame, by: list[str], order: str, value: str, width: int) -> DataFrame:
    """``df`` with frame_count and frame_sum: rows of the same ``by`` whose ``order`` is at most ``width`` less than the row's
    own and not more, and the sum of their values. Rows of one order are all in each other's frames.

    ``order`` is a whole number over the least of 64 bits (of a time, its microseconds); a row without one has those of its
    key without one in its frame. Null keys are one key, null values count as 0. A frame is the difference of two running
    sums: exact for whole numbers, in double precision for others. Running sums come from ``scan`` and are looked up by
    ``asof_join``, so that a hot key lies in many tasks, however many rows a frame has.
    """
    clash = {"frame_count", "frame_sum"} & set(df.columns)
    if clash:
        raise ValueError(f"there is a column {sorted(clash)[0]} already")
    if width < 0:
        raise ValueError("the width of a frame can't be under 0")
    names = [f"_b{i}" for i in range(len(by))]
    narrow = df.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col(order).cast("long").alias("_o"), F.col(value).alias("_x"))
    steps = scan(narrow, names, "_o", "_x").groupBy(F.struct(*names).alias("_k"), "_o").agg(F.max("row_number").alias("_n"), F.max_by("running_sum", "row_number").alias("_s"))
    steps = storage.materialise(steps, "steps")  # a row for each key and order: what all rows up to it come to
    below = F.when(F.col("_o").isNotNull(), F.coalesce(F.try_subtract(F.col("_o"), F.lit(width + 1)), F.lit(_LEAST)))
    earlier = steps.select("_k", F.coalesce("_o", F.lit(_LEAST)).alias("_below"), F.col("_n").alias("_n0"), F.col("_s").alias("_s0"))
    found = asof_join(steps.withColumn("_below", below), earlier, ["_k"], "_below", ["_n0", "_s0"])
    frames = found.select(
        F.col("_k").alias("_fk"), F.col("_o").alias("_fat"),
        (F.col("_n") - F.coalesce("_n0", F.lit(0))).alias("frame_count"), (F.col("_s") - F.coalesce("_s0", F.lit(0))).alias("frame_sum"),
    )
    rows = df.withColumns({"_rk": F.struct(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)]), "_rat": F.col(order).cast("long")})
    return rows.join(frames, (F.col("_rk") == F.col("_fk")) & F.col("_rat").eqNullSafe(F.col("_fat"))).select(*df.columns, "frame_count", "frame_sum")
