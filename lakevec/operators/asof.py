"""As-of join: each left row with the last right row of its key that is not later.

Rows of both sides are dealt by ranges of key and time, so that a key with most rows lies in many ranges. The last right
row is carried forward within a range by a window, and from range to range by a table with a row or two for each range.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import storage


def asof_join(left: DataFrame, right: DataFrame, by: list[str], ts: str, values: list[str]) -> DataFrame:
    """``left`` with ``values`` of ``right`` (null where there is none). No pairs are made, and no task gets a key as a whole.
    At equal times the right row comes first; of right rows of one time the one with the largest values counts. Null keys
    and null times match nothing, on either side. A name that ``left`` has already gets ``_right`` behind it."""
    names = [f"_v{i}" for i in range(len(values))]
    clash = {*names, "_side", "_part", "_last", "_key", "_before"} & set(left.columns)
    if clash:
        raise ValueError(f"there is a column {sorted(clash)[0]} already")
    usable = reduce(and_, [F.col(c).isNotNull() for c in (*by, ts)])
    mine = left.select(*left.columns, F.lit(1).alias("_side"), *[F.lit(None).cast(right.schema[v].dataType).alias(n) for v, n in zip(values, names, strict=True)])
    picked = right.where(usable).select(*by, ts, F.lit(0).alias("_side"), *[F.col(v).alias(n) for v, n in zip(values, names, strict=True)])
    order = [F.col(c) for c in (ts, "_side", *names)]
    dealt = mine.unionByName(picked, allowMissingColumns=True).repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id())
    rows = storage.materialise(dealt, "asof")  # ranges are sampled, so they are cut once and kept

    key, value = F.struct(*by), F.when(F.col("_side") == 0, F.struct(ts, *names))
    edges = rows.where(usable).groupBy("_part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    ends = rows.where(usable).join(F.broadcast(edges), "_part").where(key == F.col("last")).groupBy("_part", "first", "last").agg(F.max(value).alias("end"))
    # of each range (at most as many as shuffle partitions): what its last key has come to, and where its first key is to be filled
    marks = ends.select("_part", F.explode(F.array(F.struct(F.col("first").alias("key"), F.lit(0).alias("at"), F.lit(None).cast(ends.schema["end"].dataType).alias("end")), F.struct(F.col("last").alias("key"), F.lit(1).alias("at"), "end"))).alias("m")).select("_part", "m.*")
    before = F.last("end", ignorenulls=True).over(Window.partitionBy("key").orderBy("_part", "at").rowsBetween(Window.unboundedPreceding, -1))
    carried = marks.withColumn("_before", before).where("at = 0 AND _before IS NOT NULL").select("_part", F.col("key").alias("_key"), "_before")

    forward = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumn("_last", F.last(value, ignorenulls=True).over(forward)).where("_side = 1").join(F.broadcast(carried), "_part", "left")
    last = F.when(usable, F.coalesce("_last", F.when(key == F.col("_key"), F.col("_before"))))
    return filled.withColumn("_last", last).select(*left.columns, *[F.col(f"_last.{n}").alias(v if v not in left.columns else f"{v}_right") for v, n in zip(values, names, strict=True)])
