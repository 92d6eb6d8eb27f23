"""Columns kept apart and put together again by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage

#: The bits of a row's place within its range, in ``monotonically_increasing_id``.
_PLACE = 33


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, T.MapType | T.VariantType)


def with_ordinal(df: DataFrame, order: list[str], name: str = "_ordinal") -> DataFrame:
    """A gapless ordinal from 0 in the order of ``order``, without one task that sees all rows.

    Rows are dealt by ranges and sorted once, and what comes out is a table in the shared folder with each row's range and
    place in it; a row's ordinal is its place after all smaller ranges, whose sizes are a row each. All that is read later
    reads this table, so every use sees the same ordinals, however ranges were cut and whatever ties were broken. Rows that
    are equal in ``order`` get different ordinals in any order; a hash of the row spreads them over ranges.
    """
    spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
    ranged = df.withColumn("_spread", spread).repartitionByRange(*order, "_spread").sortWithinPartitions(*order, "_spread").drop("_spread")
    kept = storage.materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), "ordinals")
    part = F.shiftrightunsigned("_id", _PLACE).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each range
    starts = kept.groupBy(part).count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE) - 1))
    numbered = kept.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, (F.col("_before") + place).cast("long")).drop("_part", "_id", "_before")


def zip_columns(parts: list[DataFrame], ordinal: str = "_ordinal") -> DataFrame:
    """Join column frames on their ordinal. All are shuffled on it once; later joins find it in place."""
    return reduce(lambda a, b: a.join(b, ordinal), parts)
