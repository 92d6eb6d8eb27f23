import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevec.operators import deletes, keys, stats, topk, zipjoin
from lakevec.operators.asof import asof_join
from lakevec.plans.embed import embed


def test_deletes_against_a_model(spark):
    r = random.Random(1)
    rows = [(r.choice([None, *range(20)]), r.randint(0, 9), r.randint(1, 2)) for _ in range(300)]
    dels = [(str(r.randint(0, 19)), r.randint(0, 9), r.choice([1, 2, -1])) for _ in range(20)] + [("no number", 99, -1), (None, 99, -1)]
    df = spark.createDataFrame(rows, "k long, t long, p long").withColumn("_pk", F.lit("clash"))
    d = deletes.consolidate(deletes.keyed(spark.createDataFrame(dels, "pk string, ts long, part long"), "pk", "ts", "bigint", partition="part"))
    got = deletes.apply(df, d, "k", "t", "p")
    assert got.columns == df.columns
    want = [x for x in rows if x[0] is None or not any(str(x[0]) == k and x[1] <= t and p in (x[2], -1) for k, t, p in dels)]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((x.k, x.t, x.p) for x in got.collect()), key=key) == sorted(want, key=key)
    gone = {k for k, *_ in dels}
    assert deletes.delete_keys(df.drop("_pk"), spark.createDataFrame(dels, "pk string, ts long, part long"), "k").count() == sum(x[0] is None or str(x[0]) not in gone for x in rows)
    plan = got._jdf.queryExecution().toString()
    assert plan.count("LeftAnti") and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 1, None), (None, 5, "n")], "k long, t long, v string")
    assert sorted(map(str, deletes.latest(df, ["k"], ["t"]).collect())) == sorted(["Row(k=1, t=3, v='b')", "Row(k=2, t=1, v=None)", "Row(k=None, t=5, v='n')"])


def test_ordinals_and_zip(spark):
    df = spark.createDataFrame([(i * 7 % 101, f"v{i}") for i in range(101)], "k long, v string").repartition(5)
    rows = zipjoin.with_ordinal(df, ["k"])
    assert sorted((r._ordinal, r.k) for r in rows.collect()) == [(i, i) for i in range(101)]
    both = zipjoin.zip_columns([rows.select("_ordinal", "k"), rows.select("_ordinal", "v")])
    assert sorted((r.k, r.v) for r in both.collect()) == sorted((r.k, r.v) for r in df.collect())
    assert zipjoin.with_ordinal(df.limit(0), ["k"]).count() == 0


def test_keys(spark):
    a = spark.createDataFrame([("x", 1), ("x", 5), ("y", 2), (None, 3)], "pk string, ts long")
    b = spark.createDataFrame([("x", 3), ("z", 4)], "pk string, ts long")
    d = {r.pk: (r.occurrence_count, r.first_seen_ts, r.last_seen_ts, r.time_difference_ms) for r in keys.distribution(a).collect()}
    assert d == {"x": (2, 1, 5, 4), "y": (1, 2, 2, 0), None: (1, 3, 3, 0)}
    (r,) = keys.compare(a, b).collect()
    assert (r.pk, r.timestamps, r.sources, r.min_ts, r.max_ts) == ("x", [1, 3, 5], ["file1", "file2", "file1"], 1, 5)
    assert tuple(keys.counts(a, b).first()) == (3, 2, 1, 2, 1)
    assert {x.pk for x in keys.only_left(a, b).collect()} == {"y", None}


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
@pytest.mark.parametrize("most", [32 << 20, 200])
def test_batch_top_k(spark, monkeypatch, metric, most):
    monkeypatch.setattr(topk, "BROADCAST_BYTES", most)
    x = np.random.default_rng(2).normal(size=(120, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(500, None), (501, [1.0])], "id long, vector array<double>")
    got = topk.batch_top_k(df, df.where("id % 40 = 0"), 5, metric, exclude_self=True).collect()
    for q in (0, 40, 80):
        s = {"L2": np.linalg.norm(x - x[q], axis=1), "IP": -(x @ x[q]), "COSINE": -(x @ x[q]) / np.linalg.norm(x, axis=1)}[metric]
        want = [i for i in np.argsort(s) if i != q][:5]
        assert [r.id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want
    single = topk.top_k(df.where("size(vector) = 6"), x[0].tolist(), 3, metric).collect()
    assert single[0].id == (0 if metric != "IP" else int(np.argmax(x @ x[0])))


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
@pytest.mark.parametrize("scores", [2 << 20, 700])
def test_batch_top_k_ties(spark, monkeypatch, metric, scores):
    monkeypatch.setattr(topk, "SCORES", scores)
    r = np.random.default_rng(3)
    ids = r.permutation(1000)
    x = r.normal(size=(1000, 6))
    x[::3] = x[0]  # a third of all rows are copies
    x[0::3][:, 2] = 0
    asked = [int(ids[0]), int(ids[3]), int(ids[1])]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "id long, vector array<double>").repartition(2)
    for exclude in (False, True):
        got = topk.batch_top_k(df, df.where(F.col("id").isin(asked)), 10, metric, exclude_self=exclude).collect()
        for q in asked:
            v = x[ids == q][0]
            s = {"L2": ((x - v) ** 2).sum(1) ** 0.5, "IP": -(x * v).sum(1), "COSINE": -(x * v).sum(1) / ((x**2).sum(1) ** 0.5 * (v**2).sum() ** 0.5)}[metric]
            want = [int(ids[i]) for i in np.lexsort((ids, s)) if not exclude or ids[i] != q][:10]
            assert [r.id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want


def test_batch_top_k_near_ties(spark):
    # far from the origin, the expanded form of L2 can't tell the rows apart
    x = 1e6 + np.arange(400)[:, None] * 1e-5 * np.ones((1, 4))
    df = spark.createDataFrame([(999 - i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    got = topk.batch_top_k(df, df.where("id = 999"), 10).collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == [999 - i for i in range(10)]


def test_sparse_and_stats(spark):
    df = spark.createDataFrame([(1, {1: 2.0, 5: 1.0}), (2, {5: 4.0}), (3, {9: 1.0}), (4, None), (5, {})], "id long, vector map<long,float>")
    assert [(r.id, r.score) for r in topk.sparse_top_k(df, {5: 1.0, 1: 1.0}, 10).collect()] == [(2, 4.0), (1, 3.0)]
    assert topk.sparse_top_k(df, {}, 10).count() == 0
    s = stats.column_stats(spark.createDataFrame([(1, "b"), (None, "a")], "n long, s string"), ["n", "s"]).collect()
    assert [tuple(r) for r in s] == [("n", 2, 1, "1", "1"), ("s", 2, 2, "a", "b")]
    assert tuple(stats.percentiles(spark.range(5), "id").first()) == (0, 1.0, 2.0, 3.0, 4)
    assert stats.sample(spark.range(10), 1.0).count() == 10
    with pytest.raises(ValueError):
        stats.sample(spark.range(10), 0)


def test_asof(spark):
    left = spark.createDataFrame([("a", 5, 1.0), ("a", 1, 2.0), ("b", 5, 3.0)], "k string, t long, v double")
    right = spark.createDataFrame([("a", 2, 10.0), ("a", 5, 20.0), ("b", 9, 30.0)], "k string, t long, v double")
    got = asof_join(left, right, ["k"], "t", ["v"]).collect()
    assert sorted((r.k, r.t, r.v, r.v_right) for r in got) == [("a", 1, 2.0, None), ("a", 5, 1.0, 20.0), ("b", 5, 3.0, None)]


def test_embed(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "c d"), (3, None)], "id long, text string")
    rows = {r.id: r.vector for r in embed(df, dim=8).collect()}
    assert len(rows[1]) == 8 and rows[3] is None
