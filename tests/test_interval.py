"""Interval joins against a plain loop, and what their plans are made of."""

import random

import pytest
from pyspark.sql import functions as F

from lakevec.operators import interval
from lakevec.operators.interval import interval_join


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bins", [None, 7])
@pytest.mark.parametrize("keyed", [True, False])
def test_against_a_loop(spark, how, bins, keyed):
    r = random.Random(3)
    points = [(i, r.choice([None, "a", "b"]), r.choice([None, *range(-50, 50)])) for i in range(300)] + [(1000 + i, "a", 7) for i in range(150)]
    ranges = [(i, r.choice([None, "a", "b"]), *(r.choice([None, *range(-60, 60)]) for _ in range(2))) for i in range(60)] + [(99, "a", -1000, 1000), (98, "b", 7, 7), (97, "a", 7, 8)]
    left = spark.createDataFrame(points, "p long, k string, t int")
    right = spark.createDataFrame(ranges, "i long, k string, s int, e int") if keyed else spark.createDataFrame([(i, s, e) for i, _, s, e in ranges], "i long, s int, e int")
    got = interval_join(left, right, "t", "s", "e", ["k"] if keyed else [], how, bins, most_points=40)
    want = [(p, i) for p, k, t in points for i, j, s, e in ranges if None not in (t, s, e) and s <= t < e and (not keyed or k is not None and k == j)]
    if how == "left":
        want += [(p, None) for p in {p for p, *_ in points} - {p for p, _ in want}]
    assert sorted(((r.p, r.i) for r in got.collect()), key=str) == sorted(want, key=str)
    assert "NestedLoop" not in plan_of(got) and "CartesianProduct" not in plan_of(got)


def test_bins_follow_the_intervals(spark, monkeypatch):
    """Short intervals get many bins, those that span everything get few, so that copies stay bounded."""
    copied = []
    real = interval._bin
    monkeypatch.setattr(interval, "_bin", lambda v, c: copied.append(len(c)) or real(v, c))
    points = spark.range(20_000).select(F.col("id").alias("t"))
    short = spark.range(2000).select((F.col("id") * 10).alias("s"), (F.col("id") * 10 + 3).alias("e"))
    wide = spark.range(2000).select(F.lit(0).cast("long").alias("s"), (F.lit(20_000) - F.col("id")).alias("e"))
    assert interval_join(points, short, "t", "s", "e").count() == 6000
    assert copied[-1] >= 200
    assert interval_join(points, wide, "t", "s", "e").count() == sum(20_000 - i for i in range(2000))
    assert copied[-1] <= 16


def test_heavy_bins_are_dealt(spark):
    """One key and time with most points: no task of the join gets them all."""
    points = spark.range(40_000).select(F.lit("hot").alias("k"), F.when(F.col("id") % 4 > 0, 5).otherwise(F.col("id")).alias("t"), "id")
    ranges = spark.createDataFrame([("hot", 0, 10, "x"), ("hot", 5, 6, "y")], "k string, s long, e long, n string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = interval_join(points, ranges, "t", "s", "e", ["k"], most_points=2000)
        assert got.groupBy("n").count().orderBy("n").collect()[1]["count"] == 30_000
        most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 40_000  # of 60,000 pairs over four partitions
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_types_and_faults(spark):
    p = spark.sql("SELECT * FROM VALUES (DATE '2024-01-05'), (DATE '2024-02-05') AS t(day)")
    r = spark.sql("SELECT * FROM VALUES (DATE '2024-01-01', DATE '2024-02-01') AS t(a, b)")
    assert [str(x.day) for x in interval_join(p, r, "day", "a", "b").collect()] == ["2024-01-05"]
    assert interval_join(p.limit(0), r, "day", "a", "b").count() == 0 and interval_join(p, r.limit(0), "day", "a", "b", how="left").count() == 2
    with pytest.raises(ValueError, match="both sides"):
        interval_join(p, r.withColumnRenamed("a", "day"), "day", "day", "b")
    with pytest.raises(ValueError, match="kind"):
        interval_join(p, r, "day", "a", "b", how="full")


@pytest.mark.parametrize("bits", [12, 2])
@pytest.mark.parametrize("keyed", [True, False])
def test_aggregates_against_a_loop(spark, bits, keyed):
    """Counts and extremes of a point's intervals, blocks cut small or not, are those of all pairs."""
    r = random.Random(5)
    points = [(i, r.choice([None, "a", "b"]), r.choice([None, -0.0, *map(float, range(-50, 50))])) for i in range(400)] + [(1000 + i, "a", 7.0) for i in range(50)]
    points += [(2000, "b", float("nan")), (2001, "a", float("inf"))]
    ranges = [(i, r.choice([None, "a", "b"]), *(r.choice([None, float("nan"), *map(float, range(-60, 60))]) for _ in range(2))) for i in range(150)] + [(99, "a", -1000.0, 1000.0), (98, "b", 7.0, 7.0), (97, "a", 7.0, 8.0), (97, "a", 7.0, 8.0)]
    left = spark.createDataFrame(points, "p long, k string, t double").repartition(3)
    right = spark.createDataFrame(ranges, "i long, k string, s double, e double").repartition(3)
    aggs = {"n": ("count", "*"), "most": ("max", "i"), "least": ("min", "s"), "all": ("sum", "i")}
    got = interval.interval_aggregate(left, right, "t", "s", "e", aggs, ["k"] if keyed else None, bits)
    want = []
    for p, k, t in points:
        # NaN is the largest number in Spark
        held = [(i, s) for i, j, s, e in ranges if None not in (t, s, e) and t == t and s <= t and (e != e or t < e) and (not keyed or k is not None and k == j)]
        if held:
            want.append((p, len(held), max(i for i, _ in held), min(s for _, s in held), sum(i for i, _ in held)))
    assert sorted((x.p, x.n, x.most, x.least, x["all"]) for x in got.collect()) == sorted(want)
    assert interval.interval_aggregate(left.limit(0), right, "t", "s", "e", aggs).count() == 0 and interval.interval_aggregate(left, right.limit(0), "t", "s", "e", aggs).count() == 0
    with pytest.raises(ValueError, match="kind"):
        interval.interval_aggregate(left, right, "t", "s", "e", {"x": ("avg", "i")})


def test_aggregates_make_no_pairs(spark):
    """20,000 points in 20,000 intervals each, where a join has 400,000,000 pairs: no operator of the plan has as many as a hundredth."""
    points = spark.range(20_000).select((F.col("id") % 5000).cast("double").alias("t"), "id")
    wide = spark.range(20_000).select((-F.col("id")).cast("double").alias("s"), (5000 + F.col("id")).cast("double").alias("e"))
    got = interval.interval_aggregate(points, wide, "t", "s", "e", {"n": ("count", "*"), "s": ("max", "s")})
    assert got.agg(F.count("*"), F.min("n"), F.max("n"), F.max("s")).first() == (20_000, 20_000, 20_000, 0.0)
    rows = []

    def walk(node):
        found = node.metrics().get("numOutputRows")
        if found.isDefined():
            rows.append(found.get().value())
        inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        for x in [*inner, *[node.children().apply(i) for i in range(node.children().size())]]:
            walk(x)

    got.collect()
    walk(got._jdf.queryExecution().executedPlan())
    assert 20_000 <= max(rows) < 4_000_000


def test_prices_that_are_no_numbers(spark, tmp_path):
    """Ranges and prices of NaN, infinity, null and beyond 64 bits are as in SQL, repeated part keys are counted together."""
    import duckdb

    from lakevec.queries import ORACLE_SQL, QUERIES

    odd = [float("nan"), float("inf"), float("-inf"), None, 1e300, -0.0, 950.0, -950.9, 1e18]
    spark.createDataFrame([(i if i != 5 else None, x) for i, x in enumerate(odd * 30)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i % 7 or None, x) for i, x in enumerate([*odd, 951.5, 960.0, 0.0, 3.5] * 3)], "p_partkey long, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    for t in ("customer", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(ORACLE_SQL["interval_join_prices"]).fetchall()
    assert sorted(map(tuple, QUERIES["interval_join_prices"](spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
