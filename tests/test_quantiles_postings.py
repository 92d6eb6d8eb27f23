"""Exact quantiles against sorted values; posting lists against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevec.operators import postings, quantiles
from tests.conftest import DATA


def test_quantiles_of_odd_columns(spark):
    r = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    rows = [(float(x), int(i), None, 5) for x, i in zip(r.normal(size=997) * 10.0 ** r.integers(-300, 300, 997), r.integers(-(2**62), 2**62, 997), strict=True)]
    rows += [(0.0, 0, None, 5), (-0.0, 1, None, 5), (inf, -1, None, 5), (-inf, None, None, 5), (None, 2**63 - 1, None, 5)]
    df = spark.createDataFrame(rows, "x double, i long, none double, same int").repartition(5)
    at = (0.0, 0.1, 1 / 3, 0.5, 0.99, 1.0)
    got = {q["column"]: q for q in quantiles.quantiles(df, ["x", "i", "none", "same"], at).collect()}
    for name, values in (("x", [a for a, *_ in rows if a is not None]), ("i", [b for _, b, *_ in rows if b is not None]), ("same", [5] * len(rows))):
        s = sorted(values)
        assert (got[name].rows, got[name].min, got[name].max) == (len(s), float(s[0]), float(s[-1]))
        for p, v in zip(at, got[name][3:-1], strict=True):
            low = int(p * (len(s) - 1))
            a, b = float(s[low]), float(s[min(low + 1, len(s) - 1)])
            part = p * (len(s) - 1) - low
            assert v == (a if a == b or not part else a + (b - a) * part), (name, p)
    assert got["none"].rows == 0 and got["none"][2:] == (None,) * 8
    assert quantiles.quantiles(df.limit(0), ["x"]).first().rows == 0
    top = quantiles.quantiles(spark.createDataFrame([(1.0,), (nan,), (2.0,)], "x double"), ["x"]).first()
    assert (top.min, top.p50) == (1.0, 2.0) and np.isnan(top.max)
    with pytest.raises(ValueError):
        quantiles.quantiles(df, ["x"], (1.5,))


def test_tasks_hold_counts_only(spark):
    """What is shuffled doesn't grow with the values: a million distinct ones give at most 2**16 counts for each rank."""
    df = spark.range(1_000_000).select(F.xxhash64("id").alias("v"))
    known = [np.zeros(1, np.uint64)]
    counts = df.mapInArrow(quantiles._counted([True], known, 0), quantiles._COUNTS).groupBy(F.spark_partition_id()).count()
    assert counts.agg(F.max("count")).first()[0] <= 1 << quantiles.DIGITS
    (found,) = quantiles.numbers_at(df, ["v"], lambda n: {0, n // 2, n - 1})
    s = np.sort(np.array([r.v for r in df.collect()]))
    assert [found[i] for i in (0, 500_000, 999_999)] == [s[0], s[500_000], s[-1]]


def products(rows, query):
    out = [(i, sum(w * v[j] for j, w in query.items() if j in v)) for i, v in rows if set(v) & set(query)]
    return sorted(out, key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("shard_rows", [50_000, 70])
def test_sparse_searches(spark, tmp_path, shard_rows):
    r = np.random.default_rng(shard_rows)
    vectors = [(i, {int(j): float(np.round(r.normal(), 2)) for j in r.choice(60, r.integers(0, 9), replace=False)}) for i in range(300)]
    vectors += [(1000 + i, {3: 1.0, 8: 0.5}) for i in range(40)]  # ties
    df = spark.createDataFrame([*vectors, (None, {1: 1.0}), (2000, None), (2001, {5: float("nan")})], "id long, vector map<long,double>")
    lists = postings.build(df, str(tmp_path / "lists"), shard_rows=shard_rows)
    queries = [(1, {3: 1.0, 8: 2.0}), (2, {3: -1.0, 5: 0.5, 59: 0.1}), (3, {999: 1.0}), (4, {}), (5, {j: 0.3 for j in range(60)}), (6, None), (7, {0: float("inf"), 1: 1.0})]
    found = postings.search(lists, spark.createDataFrame(queries, "query_id long, vector map<long,double>"), 7).orderBy("query_id", "rank").collect()
    for q, vector in queries:
        want = products(vectors, {j: w for j, w in (vector or {}).items() if np.isfinite(w)})[:7]
        got = [(f.id, f.score) for f in found if f.query_id == q]
        assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want])


def test_less_than_half_is_touched(spark, tmp_path):
    x = F.map_from_entries(F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("long").alias("key"), x.alias("value"))), lambda e: e["value"] > 0))
    df = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), x.alias("vector"))
    lists = postings.build(df, str(tmp_path / "lists"))
    found = postings.search(lists, df.where("id % 100 = 0").withColumnRenamed("id", "query_id"), 10)
    looked = found.select("query_id", "touched", "held").distinct().agg(F.sum("touched"), F.sum("held"), F.count("*")).first()
    assert looked[2] == 20 and looked[0] < 0.5 * looked[1]


@pytest.mark.parametrize(("vocabulary", "tile", "portion"), [(20, 1024, 256), (20, 64, 7), (2000, 64, 16)])
def test_many_queries_are_asked_together(monkeypatch, vocabulary, tile, portion):
    """Both searches of a shard find the rows of all products, with equal scores to the last bit, copies and all."""
    monkeypatch.setattr(postings, "TILE", tile)
    monkeypatch.setattr(postings, "PORTION", portion)
    r = np.random.default_rng(vocabulary + tile)
    vector = lambda: dict(sorted((int(j), float(r.normal())) for j in r.choice(vocabulary, r.integers(1, 12), replace=False)))
    vectors = [vector() for _ in range(600)]
    vectors[::3] = [vectors[0]] * 200
    vectors[7] = {0: 0.0}
    ids = r.permutation(9000)[:600]
    queries = [*[vector() for _ in range(60)], {10**6: 1.0}, {0: -1.0}, {}, vectors[0]]
    row = np.repeat(np.arange(600), [len(v) for v in vectors])
    table = postings._shard(0, ids, row, np.array([j for v in vectors for j in v]), np.array([x for v in vectors for x in v.values()]))

    class Shared:
        value = (np.arange(len(queries)), np.append(0, np.cumsum([len(q) for q in queries])), np.array([j for q in queries for j in q]), np.array([w for q in queries for w in q.values()]))

    found = {}
    for many in (0, 1000):
        monkeypatch.setattr(postings, "MANY", many)
        rows = postings._searcher(Shared, 7)(table).to_pylist()
        looked = {x["query_id"]: (x["touched"], x["held"]) for x in rows if x["id"] is None}
        assert all(a <= b for a, b in looked.values()) and len(looked) == len(queries)
        found[many] = [sorted((-x["score"], x["id"]) for x in rows if x["query_id"] == q and x["id"] is not None) for q in range(len(queries))], {q: b for q, (_, b) in looked.items()}

    def summed(v, q):  # sum() would make up for rounding
        out = 0.0
        for j in sorted(set(v) & set(q)):
            out += q[j] * v[j]
        return out

    want = [sorted((-summed(v, q), int(i)) for i, v in zip(ids, vectors, strict=True) if set(v) & set(q))[:7] for q in queries]
    assert found[0][0] == want and found[1000] == found[0]


def test_many_queries_of_a_table(spark, tmp_path):
    """What is found over shards is as without posting lists."""
    df = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), F.map_from_entries(F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("long").alias("key"), x.alias("value"))), lambda e: e["value"] > 0)).alias("vector"))
    lists = postings.build(df, str(tmp_path / "lists"), shard_rows=900)
    found = postings.search(lists, df.where("id % 40 = 0").withColumnRenamed("id", "query_id"), 10).collect()
    x = np.maximum(np.array([r.embedding for r in spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet").orderBy("vec_id").select("embedding").collect()]), 0)
    s = x[::40] @ x.T
    assert len(found) == 500
    assert {(f.query_id, f.rank): f.id for f in found} == {(40 * q, n + 1): int(i) for q in range(50) for n, i in enumerate(np.lexsort((np.arange(2000), -s[q]))[:10])}
    assert all(np.isclose(f.score, s[f.query_id // 40, f.id]) and f.touched <= f.held for f in found)
