import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA

pytest.importorskip("lakevec.llm")
from lakevec.llm import hnsw  # noqa: E402


def brute(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


def test_recall_on_embeddings(spark):
    df = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got, want = answers(hnsw.search_table(df)), brute(ids, x, 20, 20)
    assert recall(got, want) > 0.98
    for q in want:
        assert all(s == pytest.approx(float((x[ids == q] * x[ids == i]).sum()), abs=1e-12) for i, s in got[q])


def test_lengths_clusters_and_copies(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(size=(300, 16)) * r.uniform(0.1, 3, (300, 1)), np.tile(r.normal(size=16), (400, 1)), r.normal(size=16) * 2 + 0.01 * r.normal(size=(300, 16))])
    ids = r.permutation(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got, want = answers(hnsw.search_table(df)), brute(ids, x, 20, 20)
    assert recall(got, want) > 0.95
    copies = {int(i) for i in ids[300:700]}
    for q in want:  # of copies the smallest ids come first
        if {i for i, _ in want[q]} <= copies and {i for i, _ in got[q]} <= copies:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [9.0, 9.0]), (1, [2.0, 1.0]), (40, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"shard": F.lit("clash"), "block": F.lit(1), "vector": F.lit(2)})
    got = answers(hnsw.search_table(df))
    assert got == {0: [(1, 2.0), (20, 0.5)], 20: [(1, 1.5), (0, 0.5)]}
    assert hnsw.search_table(df.limit(0)).count() == 0
    assert hnsw.search_table(df.where("vec_id = 0")).count() == 0


def test_flat_arrays_round_trip():
    r = np.random.default_rng(1)
    g = hnsw.Graph.build(np.arange(600), r.normal(size=(600, 8)), 21)
    again = hnsw.Graph.of_row(g.row(0))
    q = r.normal(size=(5, 8))
    for a, b in zip(g.nearest(np.full(5, -1), q, 10, 64), again.nearest(np.full(5, -1), q, 10, 64), strict=True):
        assert (a == b).all()
    assert len(g.levels) > 1 and all(len(a.nodes) < len(b.nodes) for a, b in zip(g.levels, g.levels[1:]))  # noqa: B905
