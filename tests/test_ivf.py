"""The inverted-file index: recall by probes, pruned cells, exact search, appends and stale indexes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevec import storage
from lakevec.catalog import Catalog, write_collection
from lakevec.operators import ivf, topk
from tests.conftest import DATA

GIVEN = {"collection.name": "v", "collection.primaryKeyField": "vec_id", "collection.vectorField": "embedding", "collection.vectorDim": 64}


@pytest.fixture(scope="module")
def clustered(spark):
    """2,000 vectors around 25 points, of many lengths; a third are one and the same vector."""
    r = np.random.default_rng(4)
    around = r.normal(size=(25, 64))
    x = np.concatenate([around[r.integers(0, 25, 1400)] + 0.15 * r.normal(size=(1400, 64)), np.tile(around[3], (600, 1))]) * r.uniform(0.5, 2, (2000, 1))
    x[1400:] = around[3]
    rows = spark.createDataFrame([(i, v.tolist(), i % 7) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    return storage.materialise(rows.repartition(6), "clustered")


@pytest.mark.parametrize("metric", ivf.METRICS)
def test_search_by_cells(spark, tmp_path, clustered, metric):
    write_collection(clustered, str(tmp_path), GIVEN)
    c = Catalog(spark, str(tmp_path))
    c.create_index("default", "v", "embedding", metric, "IVF_FLAT")
    entry = c.index("default", "v", "embedding")
    assert entry["cells"] == 44 and (metric == "IP" or entry["probes"] < 6)
    queries = clustered.where("vec_id % 97 = 0")
    want = {(r.query_id, r.id) for r in topk.batch_top_k(clustered, queries, 10, metric, "vec_id", "embedding").collect()}
    recall = lambda p: len({(r.query_id, r.id) for r in c.search_batch("default", "v", "embedding", queries, 10, probes=p).collect()} & want) / len(want)
    few, more = recall(4), recall(22)
    assert few <= more and more >= 0.9 and recall(44) == 1
    assert metric == "IP" or few >= 0.9
    q = [float(v) for v in clustered.where("vec_id = 5").first().embedding]
    exact = c.search("default", "v", "embedding", q, 10, probes=1, exact=True)
    full = topk.top_k(clustered, q, 10, metric, "vec_id", "embedding")
    assert [(r.vec_id, round(r.score, 9)) for r in exact.collect()] == [(r.vec_id, round(r.score, 9)) for r in full.collect()]
    one = c.search("default", "v", "embedding", q, 3, probes=1)
    assert len({r[0] for r in one.select("vec_id").collect()}) == 3


def test_only_probed_cells_are_opened(spark, tmp_path, clustered):
    write_collection(clustered, str(tmp_path), GIVEN)
    c = Catalog(spark, str(tmp_path))
    c.create_index("default", "v", "embedding", "L2", "IVF_FLAT", cells=20)
    entry = c.index("default", "v", "embedding")
    stored, late = c._indexed("default", "v", entry)
    assert stored.count() == 2000 and late.count() == 0
    cells = ivf.load_cells(spark, f"{entry['base']}/cells", "L2", 64, entry["longest"])
    assert cells.rows.sum() == 2000
    q = [float(v) for v in clustered.where("vec_id = 5").first().embedding]
    found = ivf.search(stored, cells, q, 5, "vec_id", "embedding", 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_cell" in plan
    near = np.argsort(cells.distances(np.array([q]))[0])[:3]
    files = stored.where(F.col("_cell").isin(near.tolist()))
    assert files.count() == cells.rows[near].sum() < 2000


def test_late_rows_filters_and_stale_indexes(spark, tmp_path, clustered):
    root = str(tmp_path)
    write_collection(clustered.where("vec_id < 1000"), root, GIVEN)
    c = Catalog(spark, root)
    c.create_index("default", "v", "embedding", "L2", "IVF_FLAT")
    write_collection(clustered.where("vec_id >= 1000"), root, {**GIVEN, "partition.name": "late"})
    q = [float(v) for v in clustered.where("vec_id = 1500").first().embedding]
    ids = lambda df: [r.vec_id for r in df.collect()]
    assert ids(c.search("default", "v", "embedding", q, 5, exact=True)) == ids(topk.top_k(clustered, q, 5, "L2", "vec_id", "embedding"))
    some = F.col("label") == 2
    assert ids(c.search("default", "v", "embedding", q, 5, where=some, exact=True)) == ids(topk.top_k(clustered.where(some), q, 5, "L2", "vec_id", "embedding"))
    assert min(ids(c.search("default", "v", "embedding", q, 5, partition="late", exact=True))) >= 1000
    storage.delete(spark, f"{root}/default/v/data/_partition=_default")  # the index has rows that are gone
    assert min(ids(c.search("default", "v", "embedding", q, 5))) >= 1000
    c.create_index("default", "v", "embedding", "L2", "IVF_FLAT")
    assert min(ids(c.search("default", "v", "embedding", q, 5, probes=99))) >= 1000
    c.drop_index("default", "v", "embedding")
    assert c.index("default", "v", "embedding") is None
    with pytest.raises(ValueError):
        c.create_index("default", "v", "label", "L2", "IVF_FLAT")


def test_odd_vectors(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [0.0, 0.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5])], "vec_id long, embedding array<double>")
    for i, metric in enumerate(ivf.METRICS):
        c = Catalog(spark, f"{tmp_path}/{i}")
        write_collection(df, c.root, {**GIVEN, "collection.vectorDim": 2})
        c.create_index("default", "v", "embedding", metric, "IVF_FLAT")
        got = [r.vec_id for r in c.search("default", "v", "embedding", [1.0, 0.0], 10, exact=True).collect()]
        assert got == ([1, 5, 5] if metric == "COSINE" else [1, 5, 5, 4])
        with pytest.raises(ValueError, match="finite"):
            c.search("default", "v", "embedding", [nan, 0.0], 1)


def test_recall_on_the_embeddings(spark, tmp_path):
    rows = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet")
    write_collection(rows, str(tmp_path), GIVEN)
    c = Catalog(spark, str(tmp_path))
    c.create_index("default", "v", "embedding", "COSINE", "IVF_FLAT")
    queries = rows.where("vec_id % 40 = 0")
    want = {(r.query_id, r.id) for r in topk.batch_top_k(rows, queries, 10, "COSINE", "vec_id", "embedding").collect()}
    found = {p: len({(r.query_id, r.id) for r in c.search_batch("default", "v", "embedding", queries, 10, probes=p).collect()} & want) / len(want) for p in (2, 22, None, 44)}
    assert found[2] < found[22] < found[44] == 1 and found[None] >= 0.9
    assert c.index("default", "v", "embedding")["probes"] < 40  # vectors without clusters, so most cells are needed
