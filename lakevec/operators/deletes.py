"""Delete semantics: which rows are left after deletes of a segment, a partition or the whole collection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The partition of deletes that hold everywhere.
EVERYWHERE = -1


def keyed(deletes: DataFrame, pk: str, ts: str, kind: str, everywhere: bool = False, partition: str | None = None) -> DataFrame:
    """(pk of ``kind``, ts, partition_id) of some deletes; keys that aren't of the kind delete nothing."""
    where = F.lit(EVERYWHERE).cast("long") if everywhere or partition is None else F.col(partition).cast("long")
    return deletes.select(F.col(pk).try_cast(kind).alias("_pk"), F.col(ts).alias("_ts"), where.alias("_partition")).where("_pk IS NOT NULL")


def consolidate(*deletes: DataFrame) -> DataFrame:
    """The latest delete of each key and partition: a row goes if its time is not after any delete, that is, not after
    the latest. Aggregated before the shuffle, so a key that is deleted over and over is one row."""
    return reduce(DataFrame.unionByName, deletes).groupBy("_pk", "_partition").agg(F.max("_ts").alias("_ts"))


def apply(rows: DataFrame, deletes: DataFrame, pk: str, ts: str | None, partition: str | None = None, ignore_ts: bool = False) -> DataFrame:
    """``rows`` without those that ``deletes`` (from ``consolidate``) remove, by one anti join.

    A row goes if a delete has its key, holds in its partition or everywhere, and is not older than the row
    (``ignore_ts``: however old). Rows with a null key stay.
    """
    same: Column = F.col("_d._pk") == F.col(f"_r.`{pk}`")
    if not ignore_ts and ts is not None:
        same &= F.col(f"_r.`{ts}`") <= F.col("_d._ts")
    if partition is not None:
        same &= F.col("_d._partition").isin(EVERYWHERE) | (F.col("_d._partition") == F.col(f"_r.`{partition}`"))
    return rows.alias("_r").join(deletes.alias("_d"), same, "left_anti")


def delete_keys(rows: DataFrame, deletes: DataFrame, pk: str, delete_pk: str = "pk") -> DataFrame:
    """Segment deletes by key alone."""
    kind = rows.schema[pk].dataType.simpleString()
    d = deletes.select(F.col(delete_pk).try_cast(kind).alias("_pk")).where("_pk IS NOT NULL").distinct()
    return rows.join(d, F.col(pk) == F.col("_pk"), "left_anti")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in ``order``; ties in all of ``order`` leave any one. An aggregate, not a window: keys
    with many versions are reduced before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_v"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_v.`{c}`").alias(c) for c in rows.columns])
