"""Joins and frames over hot keys against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from lakevec.operators import keys
from lakevec.operators.asof import asof_join
from lakevec.operators.scan import range_frame


@pytest.fixture(params=["1", "7", "40"])
def dealt(spark, request):
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield int(request.param)
    for c, v in old.items():
        spark.conf.set(c, v)


def test_asof_of_hot_keys(spark, dealt):
    r = random.Random(dealt)
    key = lambda: r.choice(["hot", "hot", "hot", "hot", None, "a", "b"])
    left = [(i, key(), r.choice([None, *range(300)])) for i in range(500)]
    right = [(key(), r.choice([None, *range(300)]), r.choice([None, 1.0, 2.0, 3.0]), i) for i in range(12)]  # few: most ranges have none
    got = asof_join(spark.createDataFrame(left, "id long, k string, t int"), spark.createDataFrame(right, "k string, t int, v double, id long"), ["k"], "t", ["v", "id"])
    assert got.columns == ["id", "k", "t", "v", "id_right"]

    def last(k, t):
        found = [x for x in right if k is not None and t is not None and x[0] == k and x[1] is not None and x[1] <= t]
        return max(((x[1], x[2] is not None, x[2] or 0, x[3]) for x in found), default=None)

    want = {i: (None, None) if (x := last(k, t)) is None else (x[2] if x[1] else None, x[3]) for i, k, t in left}
    assert {g.id: (g.v, g.id_right) for g in got.collect()} == want


def test_asof_deals_the_hot_key(spark, dealt):
    left = spark.range(20_000).select("id", F.lit("hot").alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([("hot", 5, "x"), ("hot", 9_000, "y")], "k string, t long, v string")
    got = asof_join(left, right, ["k"], "t", ["v"])
    assert {(g.v, g["count"]) for g in got.groupBy("v").count().collect()} == {(None, 5), ("x", 8_995), ("y", 11_000)}
    if dealt > 1:
        sizes = [g["count"] for g in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 20_000


def test_asof_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", 1)], "id long, k string, t int")
    right = spark.createDataFrame([("a", 1, 2.0)], "k string, t int, v double")
    assert asof_join(left.limit(0), right, ["k"], "t", ["v"]).count() == 0
    assert asof_join(left, right.limit(0), ["k"], "t", ["v"]).collect()[0].v is None


@pytest.mark.parametrize("kind", ["long", "double"])
def test_range_frames(spark, dealt, kind):
    r = random.Random(dealt)
    rows = [(i, r.choice(["hot", "hot", "hot", None, "a"]), r.choice([None, *range(-20, 60)]), r.choice([None, 1, 2, 5])) for i in range(400)]
    rows = [(i, k, o, None if v is None else (float(v) if kind == "double" else v)) for i, k, o, v in rows]
    got = range_frame(spark.createDataFrame(rows, f"id long, k string, o int, v {kind}"), ["k"], "o", "v", 7)
    assert got.columns == ["id", "k", "o", "v", "frame_count", "frame_sum"]
    inside = lambda o, x: x is None if o is None else x is not None and o - 7 <= x <= o
    want = {i: (len(f := [x for x in rows if x[1] == k and inside(o, x[2])]), sum(x[3] or 0 for x in f)) for i, k, o, _ in rows}
    assert {g.id: (g.frame_count, g.frame_sum) for g in got.collect()} == want


def test_range_frames_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "a", 5, 2), (1, "a", 5, 2), (2, "a", -(1 << 63) + 1, 3)], "id long, k string, o long, v long")
    got = range_frame(df, ["k", "id"], "o", "v", 10)
    assert sorted(tuple(g)[4:] for g in got.collect()) == [(1, 3), (2, 4), (2, 4)]  # repeated rows all stay
    assert range_frame(df.limit(0), ["k"], "o", "v", 1).count() == 0
    with pytest.raises(ValueError, match="already"):
        range_frame(df.withColumnRenamed("v", "frame_sum"), ["k"], "o", "frame_sum", 1)
    with pytest.raises(ValueError, match="under 0"):
        range_frame(df, ["k"], "o", "v", -1)


def test_compared_keys_keep_repeats(spark):
    left = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("b", 1), (None, None)], "pk string, ts long")
    right = spark.createDataFrame([("a", 2), ("c", 1), (None, 4)], "pk string, ts long")
    got = {g.pk: tuple(g)[1:] for g in keys.compare(left, right).collect()}
    assert got == {
        "a": ([1, 2, 2, 2], ["file1", "file1", "file1", "file2"], 1, 2),
        None: ([None, 4], ["file1", "file2"], 4, 4),
    }
