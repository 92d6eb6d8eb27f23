"""Schemas from footers, damaged files, relational tables by quantiles."""

import pytest
from pyspark.sql import functions as F

from lakevec.queries_sources import VERSIONS, _cut
from lakevec.sinks import column_log
from lakevec.sources import jdbc, schema_merge
from lakevec.types import CollectionSchema, Field, FieldType as T


def test_types_widen():
    cases = {(T.INT8, T.INT32): T.INT32, (T.INT64, T.FLOAT): T.DOUBLE, (T.INT16, T.FLOAT): T.FLOAT, (T.FLOAT, T.DOUBLE): T.DOUBLE, (T.STRING, T.VARCHAR): T.VARCHAR, (T.JSON, T.JSON): T.JSON}
    for (a, b), want in cases.items():
        assert schema_merge.widened(a, b) == schema_merge.widened(b, a) == want
    with pytest.raises(ValueError, match="common type"):
        schema_merge.widened(T.INT64, T.VARCHAR)


def test_versions_and_damaged_files(spark, tmp_path):
    base = str(tmp_path)
    for i, schema in enumerate(VERSIONS):
        rows = spark.range(10).select(F.lit(1).cast("long").alias("partition_id"), F.lit(i).cast("long").alias("segment_id"), F.lit(1).cast("long").alias("_ts"), *[F.when(F.col("id") > -1, F.col("id")).cast(f.spark_type()).alias(f.name) for f in schema.fields])
        column_log.write_files(column_log.encode_segments(rows, schema, 7), base, 7)
    paths, names = f"{base}/insert_log/7", {f.field_id: f.name for f in VERSIONS[2].fields}
    rows, bad = schema_merge.read_merged(spark, paths, names, 100)
    assert [f.dataType.simpleString() for f in rows.select(*names.values()).schema] == ["bigint", "double", "string", "string"] and bad.count() == 0
    assert rows.count() == 30 and rows.where("segment_id = 0 AND o_orderstatus IS NULL").count() == 10 and rows.where("o_orderpriority IS NOT NULL").count() == 10
    _cut(f"{paths}/1/1/101/0")
    (tmp_path / "insert_log/7/1/2/102/0").write_bytes(b"nonsense")
    with pytest.raises(ValueError, match="no schema"):
        schema_merge.read_merged(spark, paths, names, 100)
    rows, bad = schema_merge.read_merged(spark, paths, names, 100, skip_corrupt=True)
    assert {r.segment_id for r in rows.collect()} == {0} and bad.count() == 2
    assert [(f.name, f.type) for f in schema_merge.merge_schema(schema_merge.read_footers(spark, paths), names, 100, True).fields] == [("o_orderkey", T.INT32), ("o_totalprice", T.FLOAT)]


def test_vectors_of_two_lengths(spark, tmp_path):
    for i, dim in enumerate((2, 3)):
        schema = CollectionSchema("v", (Field("id", T.INT64, 100, primary=True, nullable=False), Field("v", T.FLOAT_VECTOR, 101, dim=dim)))
        rows = spark.range(3).select(F.lit(1).cast("long").alias("partition_id"), F.lit(i).cast("long").alias("segment_id"), F.lit(1).cast("long").alias("_ts"), "id", F.array_repeat(F.lit(0.5).cast("float"), dim).alias("v"))
        column_log.write_files(column_log.encode_segments(rows, schema, 7), str(tmp_path), 7)
    files = schema_merge.read_footers(spark, f"{tmp_path}/insert_log/7")
    assert schema_merge.merge_schema(files.where("segment_id = 1"), {100: "id", 101: "v"}, 100).by_name("v").dim == 3
    with pytest.raises(ValueError, match="bytes"):
        schema_merge.merge_schema(files, {100: "id", 101: "v"}, 100)


def test_relational_tables(spark):
    url, driver = "jdbc:derby:memory:tests;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    rows = spark.range(1, 401).select((F.col("id") * F.col("id") * F.col("id")).alias("k"), F.col("id").cast("double").alias("v"))
    jdbc.write_table(rows.coalesce(2), url, "cubes", "overwrite", driver=driver)
    even = jdbc.read_evenly(spark, url, "cubes", "k", 4, driver=driver)
    sizes = [r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and len(sizes) == 4 and max(sizes) <= 110  # equal widths would put 252 into one
    more = spark.createDataFrame([(1, -1.0), (2, -2.0)], "k long, v double")
    for _ in range(2):
        jdbc.upsert_table(more, url, "cubes", ["k"], driver=driver)
    got = {r.k: r.v for r in jdbc.read_table(spark, url, "cubes", driver=driver).collect()}
    assert len(got) == 401 and got[1] == -1.0 and got[2] == -2.0 and got[8] == 2.0
    with pytest.raises(Exception, match="null"):
        jdbc.upsert_table(spark.createDataFrame([(None, 1.0)], "k long, v double"), url, "cubes", ["k"], driver=driver)
    assert jdbc.read_table(spark, url, "cubes", driver=driver).count() == 401
