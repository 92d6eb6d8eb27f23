"""Distribution and comparison of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distribution(rows: DataFrame, pk: str = "pk", ts: str = "ts") -> DataFrame:
    """Per key: occurrence_count, first_seen_ts, last_seen_ts and their difference."""
    out = rows.groupBy(F.col(pk).alias("pk")).agg(F.count("*").alias("occurrence_count"), F.min(ts).alias("first_seen_ts"), F.max(ts).alias("last_seen_ts"))
    return out.withColumn("time_difference_ms", F.col("last_seen_ts") - F.col("first_seen_ts"))


def compare(left: DataFrame, right: DataFrame, pk: str = "pk", ts: str = "ts") -> DataFrame:
    """Per key of both sides: its times and sides (in the order of time), earliest and latest time. A null time is left out
    of the earliest and latest, and comes first.

    Rows are counted by key, time and side before a key's are brought together. A key's list is the result itself, so it has
    to fit in a row."""
    per = label(left, right, pk, ts).groupBy("pk", "ts", "source").agg(F.count("*").cast("int").alias("n"))
    sides = per.groupBy("pk").agg(F.min("source").alias("low"), F.max("source").alias("high"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.sort_array(F.collect_list(F.struct("ts", "source", "n"))).alias("all"))
    times = lambda name: F.flatten(F.transform("all", lambda x: F.array_repeat(x[name], x["n"])))
    return sides.where("low <> high").select("pk", times("ts").alias("timestamps"), times("source").alias("sources"), "min_ts", "max_ts")


def label(left: DataFrame, right: DataFrame, pk: str, ts: str) -> DataFrame:
    part = lambda df, name: df.select(F.col(pk).alias("pk"), F.col(ts).alias("ts"), F.lit(name).alias("source"))
    return part(left, "file1").unionByName(part(right, "file2"))


def common(left: DataFrame, right: DataFrame, pk: str = "pk") -> DataFrame:
    return left.select(pk).intersect(right.select(pk))


def only_left(left: DataFrame, right: DataFrame, pk: str = "pk") -> DataFrame:
    return left.select(pk).subtract(right.select(pk))


def counts(left: DataFrame, right: DataFrame, pk: str = "pk") -> DataFrame:
    """One row: distinct keys of each side, in both, and in one only, by one shuffle."""
    sides = left.select(F.col(pk).alias("pk"), F.lit(1).alias("s")).unionByName(right.select(F.col(pk).alias("pk"), F.lit(2).alias("s")))
    per = sides.groupBy("pk").agg(F.bit_or("s").alias("s"))
    n = lambda test, name: F.count_if(test).alias(name)
    s = F.col("s")
    return per.agg(n(s != 2, "left_keys"), n(s != 1, "right_keys"), n(s == 3, "common_keys"), n(s == 1, "only_left"), n(s == 2, "only_right"))
