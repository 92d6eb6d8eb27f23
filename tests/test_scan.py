"""Segmented scans against plain loops over sorted rows."""

import random

import pytest
from pyspark.sql import functions as F

from lakevec.operators.scan import scan


def plain(rows):
    out = {}
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or 0, r[0]))
    for i, (id_, k, o, v) in enumerate(rows):
        mine = [r for r in rows[: i + 1] if r[1] == k]
        less = [r for r in mine if r[2] != o]
        out[id_] = (len(mine), len(less) + 1, len({r[2] for r in less}) + 1, sum(r[3] or 0 for r in mine), mine[-2][3] if len(mine) > 1 else None)
    return out


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
@pytest.mark.parametrize("kind", ["long", "double"])
def test_hot_and_rare_keys(spark, partitions, kind):
    r = random.Random(int(partitions))
    rows = [(i, r.choice(["hot", "hot", "hot", None, "a", "b", "c"]), r.choice([None, 1, 2, 3, 4]), r.choice([None, 1, 2, 5])) for i in range(400)]
    rows = [(i, k, o, None if v is None else (float(v) if kind == "double" else v)) for i, k, o, v in rows]
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        df = spark.createDataFrame(rows, f"id long, k string, o int, v {kind}")
        got = scan(df, ["k"], "o", "v", ["id"])
        assert got.columns == ["id", "k", "o", "v", "row_number", "rank", "dense_rank", "running_sum", "previous"]
        assert {g.id: tuple(g)[4:] for g in got.collect()} == plain(rows)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_no_task_gets_the_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
        got = scan(df, ["k"], "id", "v")
        hot = got.where("k = 0")
        assert hot.agg(F.max("running_sum"), F.max("row_number")).first()[:] == (13_334, 13_334)
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert scan(df.limit(0), ["k"], "id", "v").count() == 0
    with pytest.raises(ValueError, match="already"):
        scan(df.withColumnRenamed("v", "rank"), ["k"], "id", "rank")
