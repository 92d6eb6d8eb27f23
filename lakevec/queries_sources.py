"""Queries of sources: logs of several schema versions, relational tables, forms of stored values."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import storage
from .functions import vectors
from .operators import stats
from .registry import query, table
from .sinks import column_log
from .sources import jdbc, schema_merge
from .types import CollectionSchema, Field, FieldType

_KEY, _PRICE, _STATUS, _PRIORITY = 100, 101, 102, 103


def _version(key: FieldType, price: FieldType, *more: int) -> CollectionSchema:
    texts = {_STATUS: "o_orderstatus", _PRIORITY: "o_orderpriority"}
    return CollectionSchema("orders", (Field("o_orderkey", key, _KEY, primary=True, nullable=False), Field("o_totalprice", price, _PRICE), *[Field(texts[i], FieldType.VARCHAR, i, max_length=32) for i in more]))


VERSIONS = (_version(FieldType.INT32, FieldType.FLOAT), _version(FieldType.INT64, FieldType.DOUBLE, _STATUS), _version(FieldType.INT64, FieldType.DOUBLE, _STATUS, _PRIORITY))


def _cut(path: str) -> None:
    """Take the last third of a file away."""
    system, inner = storage.worker_fs(path)
    with system.open_input_stream(inner) as f:
        data = f.read()
    with system.open_output_stream(inner) as out:
        out.write(data[: len(data) * 2 // 3])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) ELSE CAST(o_totalprice AS DOUBLE) END AS o_totalprice,
  CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 4 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 4 < 3""")
def merged_versions(spark, d):
    """Segments of three schema versions, and one with a cut file, read in the schema that their footers add up to."""
    base = storage.scratch(spark, "versions")
    orders = table(spark, d, "orders")
    for i, schema in enumerate((*VERSIONS, VERSIONS[2])):
        rows = orders.where(F.col("o_orderkey") % 4 == i).select(F.lit(i).cast("long").alias("partition_id"), (F.col("o_orderkey").cast("long") % 3 + 10 * i).alias("segment_id") if i < 3 else F.lit(99).cast("long").alias("segment_id"), F.lit(1).cast("long").alias("_ts"), *[F.col(f.name).cast(f.spark_type()).alias(f.name) for f in schema.fields])
        column_log.write_files(column_log.encode_segments(rows, schema, 7), base, 7)
    _cut(f"{base}/insert_log/7/3/99/{_PRICE}/0")
    names = {f.field_id: f.name for f in VERSIONS[2].fields}
    return schema_merge.read_merged(spark, f"{base}/insert_log/7", names, _KEY, skip_corrupt=True)[0].select(*names.values())


@query("SELECT CAST(c_custkey AS BIGINT) * c_custkey * c_custkey AS k, c_name, CASE WHEN c_custkey % 3 = 0 THEN -1.0 ELSE CAST(c_acctbal AS DOUBLE) END AS bal FROM customer")
def jdbc_skewed_key(spark, d):
    """Customers in a relational table with a skewed key: upserted twice, read by parts of equal size."""
    url, driver = f"jdbc:derby:memory:{storage.scratch(spark, 'db').rpartition('/')[2]};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    key = F.col("c_custkey").cast("long")
    rows = table(spark, d, "customer").select((key * key * key).alias("k"), "c_name", F.col("c_acctbal").cast("double").alias("bal"), "c_custkey")
    jdbc.write_table(rows.drop("c_custkey").where("c_custkey % 2 = 0"), url, "customers", "overwrite", driver=driver)
    changed = rows.withColumn("bal", F.when(F.col("c_custkey") % 3 == 0, -1.0).otherwise(F.col("bal"))).drop("c_custkey")
    for _ in range(2):
        jdbc.upsert_table(changed.coalesce(2), url, "customers", ["k"], driver=driver)
    return jdbc.read_evenly(spark, url, "customers", "k", 4, driver=driver)


@query("""WITH e AS (SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
  SELECT vec_id, i AS at, round(CASE WHEN x = 0 THEN 0 ELSE trunc(x / pow(2.0, greatest(floor(log2(abs(x))), -14) - 10)) * pow(2.0, greatest(floor(log2(abs(x))), -14) - 10) END, 6) AS x FROM e""")
def f16_truncated_roundtrip(spark, d):
    """Half precision by cutting the mantissa, big-endian."""
    halves = table(spark, d, "embeddings").select("vec_id", vectors.floats_to_half_truncated(F.col("embedding")).alias("b"))
    swapped = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), (F.octet_length("b") / 2 - 1).cast("int")), lambda i: F.concat(F.substring(F.hex("b"), i * 4 + 3, F.lit(2)), F.substring(F.hex("b"), i * 4 + 1, F.lit(2)))), ""))
    back = halves.select("vec_id", F.posexplode(vectors.floats_from_half(swapped)).alias("at", "x"))
    return back.select("vec_id", "at", F.round(F.col("x").cast("double"), 6).alias("x"))


@query("SELECT vec_id, CAST(list_sum(list_transform(range(1, 65), lambda i: CAST(embedding[i] > 0 AS INTEGER))) AS INTEGER) AS ones FROM embeddings")
def base64_bits(spark, d):
    """Binary vectors that come as base64 text."""
    text = table(spark, d, "embeddings").select("vec_id", F.base64(vectors.sign_bytes(F.col("embedding"))).alias("t"))
    bits = vectors.packed_bits(F.col("t"), 64)
    ones = F.aggregate(F.transform(F.split(F.hex(bits), ""), lambda h: F.bit_count(F.conv(h, 16, 10).cast("int"))), F.lit(0), lambda s, x: s + x)
    return text.select("vec_id", ones.alias("ones"))


@query("SELECT count(*) AS n, true AS near FROM orders")
def sampled_rows(spark, d):
    """A Bernoulli sample has about its share of the rows, a ratio over 0.99 is everything."""
    orders = table(spark, d, "orders")
    part = stats.sample(orders, 0.5, 7).agg(F.count("*").alias("some"))
    return stats.sample(orders, 0.995).agg(F.count("*").alias("n")).join(part).select("n", (F.abs(F.col("some") / F.col("n") - 0.5) < 0.1).alias("near"))
