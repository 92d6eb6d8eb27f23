"""Queries of indexes: vectors by cell, posting lists, zone maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import storage
from .catalog import Catalog, write_collection
from .operators import postings
from .plans import collection as plans
from .registry import query, table
from .sources import zonemap

_V = "CAST(embedding AS DOUBLE[])"
_Q = f"(SELECT {_V} FROM embeddings WHERE vec_id = 7)"


def _asked(spark, d) -> list[float]:
    return [float(x) for x in table(spark, d, "embeddings").where("vec_id = 7").first()["embedding"]]


def _indexed(spark, d, metric: str) -> Catalog:
    """All vectors in a collection with an inverted-file index, the last tenth of them appended after it was made."""
    root, rows = storage.scratch(spark, "indexed"), table(spark, d, "embeddings")
    given = {"collection.name": "v", "collection.primaryKeyField": "vec_id", "collection.vectorField": "embedding", "collection.vectorDim": 64}
    write_collection(rows.where("vec_id % 10 <> 9"), root, given)
    catalog = Catalog(spark, root)
    catalog.create_index("default", "v", "embedding", metric, "IVF_FLAT")
    write_collection(rows.where("vec_id % 10 = 9"), root, given)
    return catalog


def _exact_search(metric: str):
    def run(spark, d):
        found = _indexed(spark, d, metric).search("default", "v", "embedding", _asked(spark, d), 10, ["label"], probes=1, exact=True)
        return found.withColumn("score", F.round("score", 6))

    run.__doc__ = "The nearest rows through an inverted-file index that opens cells as long as they may hold a nearer one."
    return run


for _name, _metric, _fn, _way in (("ivf_l2", "L2", "list_distance", "ASC"), ("ivf_ip", "IP", "list_inner_product", "DESC"), ("ivf_cosine", "COSINE", "list_cosine_similarity", "DESC")):
    _run = _exact_search(_metric)
    _run.__name__ = _name
    query(f"SELECT vec_id, round({_fn}({_V}, {_Q}), 6) AS score, label FROM embeddings ORDER BY {_fn}({_V}, {_Q}) {_way}, vec_id LIMIT 10")(_run)


@query(f"""WITH p AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS s FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0)
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s, id) AS INTEGER) AS rank, id, round(s, 6) AS score FROM p QUALIFY rank <= 10""")
def ivf_batch_all_cells(spark, d):
    """With all cells probed, the batched search through the index is the exact one."""
    queries = table(spark, d, "embeddings").where("vec_id % 100 = 0")
    return _indexed(spark, d, "L2").search_batch("default", "v", "embedding", queries, 10, probes=1 << 20).withColumn("score", F.round("score", 6))


@query("SELECT true AS enough, count(*) AS queries FROM embeddings WHERE vec_id % 20 = 0")
def ivf_recall(spark, d):
    """Whether the probes that the index has measured give nine of ten of the exact ten nearest, over all queries."""
    rows = table(spark, d, "embeddings")
    queries, catalog = rows.where("vec_id % 20 = 0"), _indexed(spark, d, "COSINE")
    some, all_ = (catalog.search_batch("default", "v", "embedding", queries, 10, probes=p).select("query_id", "id") for p in (None, 1 << 20))
    both = all_.join(some.withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return both.agg((F.sum(F.coalesce("hit", F.lit(0))) / F.count("*") >= 0.9).alias("enough"), F.count_distinct("query_id").alias("queries"))


# --- posting lists


def _positive(v: str):
    return F.map_from_entries(F.filter(F.transform(v, lambda x, i: F.struct(i.cast("long").alias("key"), x.alias("value"))), lambda e: e["value"] > 0))


@query("""WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings), p AS (SELECT * FROM e WHERE v > 0),
  s AS (SELECT q.vec_id AS query_id, p.vec_id AS id, sum(q.v * p.v) AS s FROM p q JOIN p ON q.i = p.i WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER) AS rank, id, round(s, 6) AS score FROM s QUALIFY rank <= 10""")
def sparse_postings(spark, d):
    """The sparse vectors with the largest inner products for many queries, through posting lists with block maxima."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), _positive("embedding").alias("vector"))
    lists = postings.build(rows, storage.scratch(spark, "postings"))
    found = postings.search(lists, rows.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 10)
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


# --- zone maps


def _zoned(spark, d, name: str):
    from .queries import _COLLECTION, _ORDERS, _delete_files, _written

    base = _written(spark, d, name)
    _delete_files(spark, d, base)
    return base, zonemap.build(spark, f"{base}/insert_log/{_COLLECTION}", _ORDERS), _ORDERS, _COLLECTION


_LIVE = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0 AND NOT (o_orderkey % 11 = 0 AND o_orderkey % 2 = 1)"


@query(f"SELECT * FROM ({_LIVE}) WHERE o_orderkey % 997 = 5")
def zoned_keys(spark, d):
    """Some keys of a collection: only segments whose range and filter may have one are opened."""
    base, zones, schema, collection = _zoned(spark, d, "zoned")
    keys = table(spark, d, "orders").where("o_orderkey % 997 = 5").select(F.col("o_orderkey").alias("key"))
    return plans.read_collection(spark, base, schema, collection, zones=storage.materialise(zones, "zones"), keys=keys)


@query(_LIVE)
def zoned_deletes(spark, d):
    """The live collection, its deletes joined only to segments that may have a deleted key."""
    base, zones, schema, collection = _zoned(spark, d, "zoned")
    return plans.read_collection(spark, base, schema, collection, zones=storage.materialise(zones, "zones"))


@query("SELECT ascii(o_orderstatus) AS partition_id, count(*) AS rows, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders GROUP BY 1")
def zone_ranges(spark, d):
    zones = _zoned(spark, d, "ranges")[1]
    return zones.groupBy(F.col("partition_id").cast("int").alias("partition_id")).agg(F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most"))
