import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevec.catalog import Catalog, write_collection
from lakevec.options import Options
from lakevec.types import CollectionSchema, Field, FieldType

OPTIONS = {"collection.name": "c", "collection.primaryKeyField": "id", "collection.vectorField": "vec", "collection.vectorDim": 2}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, vec array<double>, text string")


def test_append_read_search(spark, tmp_path):
    root = str(tmp_path)
    df = frame(spark, [(1, [0.0, 1.0], "a"), (2, [1.0, 0.0], "b")])
    assert write_collection(df, root, OPTIONS) == 2
    assert write_collection(df.select("text", "vec", (F.col("id") + 2).alias("id")), root, {**OPTIONS, "PARTITION.NAME": "p"}) == 2
    c = Catalog(spark, root)
    got = c.read("default", "c")
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "array<float>", "string"] and got.schema["vec"].metadata["dim"] == 2
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4] and [r.id for r in c.read("default", "c", "p").orderBy("id").collect()] == [3, 4]
    c.create_index("default", "c", "vec", "IP")
    assert [r.id for r in c.search("default", "c", "vec", [0.0, 2.0], 2, ["text"]).collect()] == [1, 3]
    assert [r.id for r in c.search("default", "c", "vec", [0.0, 2.0], 1, where=F.col("text") == "b", metric="L2").collect()] == [2]
    assert c.flush("default", "c") == 4
    with pytest.raises(ValueError):
        c.create_index("default", "c", "vec", kind="NOPE")
    with pytest.raises(ValueError):
        c.ensure("default", CollectionSchema("c", (Field("other", FieldType.INT64, 100, primary=True),)))


def test_bad_rows_publish_nothing(spark, tmp_path):
    root = str(tmp_path)
    write_collection(frame(spark, [(1, [0.0, 1.0], "a")]), root, OPTIONS)
    with pytest.raises(Exception, match="2 components"):
        write_collection(frame(spark, [(2, [0.0, 1.0], "a"), (3, [0.0], "b")]).repartition(2), root, OPTIONS)
    assert Catalog(spark, root).read("default", "c").count() == 1
    with pytest.raises(ValueError, match="id"):
        Catalog(spark, root).append(spark.createDataFrame([("x",)], "text string"), "default", "c")


def test_made_keys_and_all_types(spark, tmp_path):
    schema = CollectionSchema(
        "t",
        (
            Field("id", FieldType.INT64, 100, primary=True, auto_id=True, nullable=False), Field("b", FieldType.BINARY_VECTOR, 101, dim=32), Field("s", FieldType.SPARSE_FLOAT_VECTOR, 102),
            Field("j", FieldType.JSON, 103), Field("i", FieldType.INT8, 104), Field("h", FieldType.BFLOAT16_VECTOR, 105, dim=2), Field("missing", FieldType.INT32, 106),
        ),
    )
    c = Catalog(spark, str(tmp_path))
    c.ensure("db", schema)
    assert c.describe("db", "t") == schema
    df = spark.createDataFrame([("P0xnDg==", '{"3": 0.5}', '{"a": 1}', 5, "gD8AQA==")], "b string, s string, j string, i int, h string")
    assert c.append(df, "db", "t") == 1
    r = c.read("db", "t").first()
    assert len(r.b) == 4 and r.s == {3: 0.5} and r.i == 5 and r.h == [1.0, 2.0] and r.missing is None and r.id > 0
    with pytest.raises(Exception, match="JSON"):
        c.append(df.withColumn("j", F.lit("{")), "db", "t")
    with pytest.raises(Exception):  # noqa: B017  300 is no byte
        c.append(df.withColumn("i", F.lit(300)), "db", "t")
    assert c.search("db", "t", "s", {3: 2.0}).first()["score"] == 1.0


def test_bulk_import(spark, tmp_path):
    rows = frame(spark, [(i, [0.0, 1.0], "t") for i in range(6)])
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    c = Catalog(spark, f"{tmp_path}/store")
    c.ensure("default", CollectionSchema.from_struct("c", rows.schema, "id", "vec", 2))
    (tmp_path / "in/broken.parquet").write_text("x")
    seen = []
    jobs = {r.file.rsplit("/", 1)[1]: r for r in c.bulk_import("default", "c", f"{tmp_path}/in", report=seen.append).collect()}
    assert sorted(j.state for j in jobs.values()) == ["done", "done", "done", "failed"] and jobs["broken.parquet"].error and len(seen) == 4
    assert c.read("default", "c").count() == 6
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text(json.dumps({"rows": [{"id": 9, "vec": [1.0, 2.0], "text": "x"}]}))
    assert [r.state for r in c.bulk_import("default", "c", f"{tmp_path}/j", "json").collect()] == ["done"]


def test_schema_of_a_frame():
    s = T.StructType().add("id", T.ShortType()).add("v", T.ArrayType(T.FloatType())).add("t", T.StringType()).add("a", T.ArrayType(T.StringType())).add("k", T.ByteType())
    c = CollectionSchema.from_struct("c", s, "id", "v", 8)
    assert [f.type.name for f in c.fields] == ["INT64", "FLOAT_VECTOR", "VARCHAR", "ARRAY", "INT8"] and c.by_name("v").dim == 8
    assert CollectionSchema.from_struct("c", c.to_struct(), "id").by_name("v") == c.by_name("v")
    for bad in (T.DateType(), T.DecimalType(), T.StructType(), T.TimestampType()):
        with pytest.raises(ValueError):
            CollectionSchema.from_struct("c", T.StructType().add("id", T.LongType()).add("x", bad), "id")
    with pytest.raises(ValueError):
        CollectionSchema.from_struct("c", s, "nope")


def test_options():
    o = Options({"Collection.Name": "c", "SECURE": "false", "insertMaxBatchSize": 7})
    assert o["collection.name"] == "c" and o.number("insertmaxbatchsize") == 7 and o["port"] == "19530" and o.database == "default"
    with pytest.raises(ValueError):
        Options({"secure": "true"})
    assert Options({"secure": "true", "secure.serverPemPath": "x"}).connection()["serverpempath"] == "x"
    cloud = Options({"uri": "https://in01-abc.serverless.aws-eu-central-1.cloud.example.com", "cloud.apiKey": "k"})
    assert cloud["cloud.instanceid"] == "in01-abc" and cloud["cloud.region"] == "aws-eu-central-1" and cloud.database == ""
    assert Options({"bucket": "b"}).base_path() == "s3a://b/files"
    with pytest.raises(KeyError):
        o["nope"]


def test_data_source(spark, tmp_path):
    from lakevec.sources import datasource

    datasource.register(spark)
    o = {k: str(v) for k, v in OPTIONS.items()}
    df = frame(spark, [(i, [float(i), 1.0], "t") for i in range(7)]).repartition(3)
    df.write.format("collection").options(**o).mode("append").save(str(tmp_path))
    df.select("text", "vec", F.col("id") + 7).toDF("text", "vec", "id").write.format("collection").options(**o, **{"partition.name": "p"}).mode("append").save(str(tmp_path))
    got = spark.read.format("collection").options(**o).load(str(tmp_path))
    assert sorted(r.id for r in got.collect()) == list(range(14)) and got.schema["vec"].dataType.simpleString() == "array<float>"
    assert spark.read.format("collection").options(**o, **{"partition.name": "p"}).load(str(tmp_path)).count() == 7
    assert Catalog(spark, str(tmp_path)).read("default", "c").count() == 14
    bad = frame(spark, [(50, [0.0, 1.0], "a"), (51, [0.0], "b")]).repartition(2)
    with pytest.raises(Exception):  # noqa: B017
        bad.write.format("collection").options(**o).mode("append").save(str(tmp_path))
    assert Catalog(spark, str(tmp_path)).read("default", "c").count() == 14
    df.limit(2).write.format("collection").options(**o).mode("overwrite").save(str(tmp_path))
    assert Catalog(spark, str(tmp_path)).read("default", "c").count() == 9


def test_cloud_import():
    from lakevec.sinks.cloud_import import ImportFailed, start, wait

    calls = []
    reports = iter([{"readyPercentage": 0.3}, {"readyPercentage": 1, "errorMessage": "null"}])

    def client(method, url, headers, body):
        calls.append((method, url, body))
        return {"code": 200, "data": {"jobId": 7} if method == "POST" else next(reports)}

    o = Options({"collection.name": "c", "cloud.apiKey": "k", "cloud.instanceID": "i"})
    assert start(client, "https://x/v1/", o, "s3a://b/p", "a", "s") == "7" and calls[0][2]["objectUrl"] == "s3://b/p"
    assert wait(client, "https://x/v1", o, "7", sleep=lambda s: None)["readyPercentage"] == 1
    with pytest.raises(ImportFailed):
        wait(lambda *a: {"code": 500}, "x", o, "7")
    with pytest.raises(ImportFailed):
        wait(lambda *a: {"code": 200, "data": {"errorMessage": "bad"}}, "x", o, "7")
    with pytest.raises(TimeoutError):
        wait(lambda *a: {"code": 200, "data": {}}, "x", o, "7", timeout_s=6, sleep=lambda s: None)


def test_jdbc_options():
    from lakevec.sources import jdbc

    assert jdbc.options("jdbc:x", "t", user="u", numPartitions=4) == {"url": "jdbc:x", "dbtable": "t", "user": "u", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc.read_table(None, "jdbc:x", "t", split_on="id")


def test_type_predicates():
    assert FieldType.INT8.is_integer and FieldType.DOUBLE.is_numeric and not FieldType.JSON.is_numeric and FieldType.VARCHAR.is_text
    assert FieldType.SPARSE_FLOAT_VECTOR.is_vector and not FieldType.ARRAY.is_vector and FieldType(101) is FieldType.FLOAT_VECTOR
    with pytest.raises(ValueError):
        FieldType(77)


def test_data_source_with_filters(spark, tmp_path):
    from lakevec.sources import datasource

    datasource.register(spark)
    o = {"collection.name": "c", "collection.primaryKeyField": "id", "insertMaxBatchSize": "10"}
    rows = [(i, None if i < 20 else f"t{i:03d}", float("nan") if i == 5 else float(i)) for i in range(100)]
    spark.createDataFrame(rows, "id long, text string, x double").coalesce(1).write.format("collection").options(**o).mode("append").save(str(tmp_path))
    stored = spark.read.format("collection").options(**o).load(str(tmp_path))
    for where in ("id = 37", "id > 88", "id >= 90", "id < 3", "id <= 10", "id IN (1, 99, 500)", "text = 't050'", "text > 't09'", "text IS NOT NULL", "text IS NULL", "x > 97", "x = 5", "id > 10 AND text < 't03'", "id = 1 OR id = 99", "id > 1000"):
        want = spark.createDataFrame(rows, "id long, text string, x double").where(where)
        assert sorted(r.id for r in stored.where(where).collect()) == sorted(r.id for r in want.collect()), where
        assert stored.count() == 100  # no filter outlives its query
    narrow = spark.read.schema("id long").format("collection").options(**o).load(str(tmp_path))
    assert narrow.columns == ["id"] and narrow.count() == 100


def test_files_are_split_by_row_groups(tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from lakevec.sources import datasource

    pq.write_table(pa.table({"id": range(1000), "s": ["a"] * 1000}), f"{tmp_path}/f.parquet", row_group_size=100)

    def read():
        reader = datasource._TableReader(str(tmp_path), ["id"])
        return [[x for b in reader.read(p) for x in b.column(0).to_pylist()] for p in reader.partitions()]

    assert read() == [list(range(1000))]
    monkeypatch.setattr(datasource, "SPLIT_BYTES", 2000)
    parts = read()
    assert len(parts) > 3 and sum(parts, []) == list(range(1000)) and all(len(p) < 1000 for p in parts)
