import io
import json
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakevec import storage
from lakevec.plans import collection as plans
from lakevec.sinks import column_log, rows_json as sink
from lakevec.sources import backup, codec, datasource, logs, rows_json
from lakevec.types import CollectionSchema, Field, FieldType

VALUES = [
    (Field("x", FieldType.BOOL), pa.array([True, None, False])),
    (Field("x", FieldType.INT8), pa.array([1, -128, None], pa.int8())),
    (Field("x", FieldType.INT16), pa.array([300, None], pa.int16())),
    (Field("x", FieldType.INT32), pa.array([1 << 30], pa.int32())),
    (Field("x", FieldType.INT64), pa.array([1 << 60, None])),
    (Field("x", FieldType.FLOAT), pa.array([1.5], pa.float32())),
    (Field("x", FieldType.DOUBLE), pa.array([1.1, None])),
    (Field("x", FieldType.VARCHAR), pa.array(["é", "", None])),
    (Field("x", FieldType.JSON), pa.array(['{"a": 1}'])),
    (Field("x", FieldType.ARRAY, element=FieldType.INT64), pa.array([[1, 2], [], None])),
    (Field("x", FieldType.FLOAT_VECTOR, dim=2), pa.array([[1.0, 2.0], None], pa.list_(pa.float32()))),
    (Field("x", FieldType.FLOAT16_VECTOR, dim=2), pa.array([[1.0, 0.5]], pa.list_(pa.float32()))),
    (Field("x", FieldType.BFLOAT16_VECTOR, dim=2), pa.array([[1.0, -2.0]], pa.list_(pa.float32()))),
    (Field("x", FieldType.BINARY_VECTOR, dim=16), pa.array([b"ab", None])),
    (Field("x", FieldType.SPARSE_FLOAT_VECTOR), pa.array([[(1, 0.5), (9, 2.0)], []], pa.map_(pa.int64(), pa.float32()))),
]


def of(field=100, collection=1, partition=2, segment=3, start=5, end=9, kind=FieldType.INT64):
    return codec.Descriptor(collection, partition, segment, field, start, end, int(kind))


@pytest.mark.parametrize(("field", "values"), VALUES, ids=lambda x: x.type.name if isinstance(x, Field) else "")
def test_every_type_round_trips(field, values):
    data = codec.encode(pa.table({"val": codec.to_storage(values, field)}), of(kind=field.type))
    (event,) = codec.read_events(data)
    assert codec.from_storage(codec.column_of(event), field).to_pylist() == values.to_pylist()


def test_layout():
    data = codec.encode(pa.table({"val": [1, 2]}), of())
    assert struct.unpack_from("<i", data)[0] == 0x00FFFABC
    ts, kind, length, after = struct.unpack_from("<qBii", data, 4)
    assert (ts, kind, 4 + length) == (5, 0, after)
    assert struct.unpack_from("<6qi", data, 21) == (1, 2, 3, 100, 5, 9, 5) and data[73:81] == bytes([52] + [16] * 7)
    assert data[after + 33 : after + 37] == b"PAR1" == data[-4:]
    d = codec.read_descriptor(data)
    assert int(d.extras["original_size"]) == len(data) - after - 33


def test_events_that_hold_no_rows_are_passed_over():
    table = pa.table({"val": [1]})
    data = codec.encode_events([(codec.INSERT, table), (codec.CREATE_PARTITION, b"ddl"), (codec.INDEX_FILE, b"x" * 9), (codec.DELETE, table)], of())
    assert [e.kind for e in codec.read_events(data)] == [codec.INSERT, codec.DELETE]


def test_broken_files():
    good = codec.encode(pa.table({"val": [1]}), of())
    for bad in (b"", b"x" * 100, good[:60], b"\0" + good[1:]):
        with pytest.raises(ValueError):
            list(codec.read_events(bad))
    cut = bytearray(good)
    struct.pack_into("<i", cut, codec.read_descriptor(good).first_event + 9, 5)
    with pytest.raises(ValueError):
        list(codec.read_events(bytes(cut)))
    with pytest.raises(ValueError):
        codec.to_storage(pa.array([[1.0]], pa.list_(pa.float32())), Field("x", FieldType.FLOAT_VECTOR, dim=2))


def test_delete_payloads():
    records = pa.table({"val": ['{"pk": 42, "ts": 455257023810633736, "pkType": 5}', '{"pk": "k", "ts": 1}', "17"]})
    two = pa.table({"pk": [1, 2], "ts": [10, 20]})
    text = pa.table({"pk": ["a"], "ts": [7]})
    alone = pa.table({"pk": [5]})
    data = codec.encode_events([(codec.DELETE, x) for x in (records, two, text, alone)], of())
    keys, stamps, _ = codec.delete_rows(data)
    assert list(zip(keys, stamps, strict=True)) == [("42", 455257023810633736), ("k", 1), ("17", 9), ("1", 10), ("2", 20), ("a", 7), ("5", 9)]


SCHEMA = CollectionSchema("c", (Field("id", FieldType.INT64, 100, primary=True, nullable=False), Field("v", FieldType.FLOAT_VECTOR, 101, dim=2), Field("s", FieldType.VARCHAR, 102)))


@pytest.fixture
def written(spark, tmp_path):
    rows = [(p, 10 * p + s, 100 + i, p * 1000 + s * 100 + i, [float(i), 0.5], f"t{i}" if i else None) for p in (1, 2) for s in (1, 2) for i in range(5)]
    df = spark.createDataFrame(rows, "partition_id long, segment_id long, _ts long, id long, v array<float>, s string")
    n = column_log.write_files(column_log.encode_segments(df, SCHEMA, 7), str(tmp_path), 7)
    assert n == 4 * 5
    return df, tmp_path


def test_segments(spark, written):
    df, path = written
    got = logs.read_segments(spark, f"{path}/insert_log/7", SCHEMA)
    cols = ["partition_id", "segment_id", "_ts", "id", "v", "s"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, df.select(cols).collect()))
    assert got.select(F.max("_ordinal")).first()[0] == 4
    assert logs.read_segments(spark, f"{path}/insert_log/7", SCHEMA, ["id"]).columns == ["partition_id", "segment_id", "_ordinal", "_ts", "id"]
    more = CollectionSchema("c", (*SCHEMA.fields, Field("new", FieldType.INT64, 109)))
    assert logs.read_segments(spark, f"{path}/insert_log/7", more).where("new IS NULL").count() == 20
    must = CollectionSchema("c", (*SCHEMA.fields, Field("new", FieldType.INT64, 109, nullable=False)))
    with pytest.raises(Exception, match="no column new"):
        logs.read_segments(spark, f"{path}/insert_log/7", must).count()


def test_unequal_columns_raise(spark, written):
    _, path = written
    (path / "insert_log/7/1/11/101/0").write_bytes(codec.encode(pa.table({"val": codec.to_storage(pa.array([[1.0, 2.0]], pa.list_(pa.float32())), SCHEMA.fields[1])}), of(101)))
    with pytest.raises(Exception, match="different lengths"):
        logs.read_segments(spark, f"{path}/insert_log/7", SCHEMA).count()


def test_meta_stats_and_data_sources(spark, written):
    _, path = written
    datasource.register(spark)
    meta = logs.read_meta(spark, f"{path}/insert_log/7").where("field_id = 100")
    assert [(r.segment_id, r.rows, r.events) for r in meta.orderBy("segment_id").collect()] == [(s, 5, 1) for s in (11, 12, 21, 22)]
    assert spark.read.format("log_meta").load(f"{path}/insert_log/7").count() == 20
    s = logs.read_stats(spark, f"{path}/insert_log/7/1/11/100").first()
    assert (s.rows, s.nulls, s.min, s.max) == (5, 0, "1100", "1104")
    assert spark.read.format("log_stats").load(f"{path}/insert_log/7/1/11/100").first()["max"] == "1104"
    v = spark.read.format("column_log").options(fieldType="FLOAT_VECTOR", dim=2, column="v").load(f"{path}/insert_log/7/1/11/101")
    assert v.columns == ["v"] and v.count() == 5 and v.first()["v"] == [0.0, 0.5]
    one = logs.read_column(spark, f"{path}/insert_log/7/1/11/102", SCHEMA.fields[2]).orderBy("ordinal").collect()
    assert [r.value for r in one] == [None, "t1", "t2", "t3", "t4"]


def test_column_log_sink(spark, tmp_path):
    datasource.register(spark)
    out = f"{tmp_path}/f"
    spark.range(450).repartition(3).write.format("column_log").options(column="id", segmentId=4).mode("append").save(out)
    assert sorted(r[0] for r in spark.read.format("column_log").option("column", "id").load(out).collect()) == list(range(450))
    bad = spark.range(10).repartition(2).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):  # noqa: B017
        bad.write.format("column_log").option("column", "id").mode("append").save(f"{tmp_path}/g")
    assert not [p for p in (tmp_path / "g").glob("*") if not p.name.startswith("_")]


def test_deletes_by_folder_and_glob(spark, tmp_path):
    datasource.register(spark)
    d = spark.createDataFrame([(1, 5, "1", 10), (1, 5, "2", 20), (-1, 6, "3", 30)], "partition_id long, segment_id long, pk string, ts long")
    column_log.write_files(column_log.encode_deletes(d, 7), str(tmp_path), 7, "delta_log")
    want = [("1", 10, 1), ("2", 20, 1), ("3", 30, -1)]
    rows = lambda x: sorted((r.pk, r.ts, r.partition_id) for r in x.collect())
    assert rows(logs.read_deletes(spark, f"{tmp_path}/delta_log/7")) == want
    assert rows(logs.read_deletes(spark, f"{tmp_path}/delta_log/7/*/*/*")) == want
    assert rows(spark.read.format("delete_log").load(f"{tmp_path}/delta_log/7")) == want
    assert logs.read_deletes(spark, []).count() == 0
    with pytest.raises(FileNotFoundError):
        logs.read_deletes(spark, f"{tmp_path}/nothing/*")


def model(rows, dels):
    """Plain Python: rows (partition, ts, pk) that no delete (partition, ts, pk) removes."""
    return sorted((p, t, k) for p, t, k in rows if k is None or not any(k == dk and t <= dt and dp in (p, -1) for dp, dt, dk in dels))


def test_live_rows_against_a_model(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(int(p), int(t), int(k)) for p, t, k in zip(r.integers(1, 3, 200), r.integers(0, 50, 200), r.integers(0, 60, 200), strict=True)]
    dels = [(int(p), int(t), int(k)) for p, t, k in zip(r.choice([1, 2, -1], 40), r.integers(0, 50, 40), r.integers(0, 60, 40), strict=True)]
    df = spark.createDataFrame([(p, 10 * p + t % 2, t, k, [0.0, 1.0], "x") for p, t, k in rows], "partition_id long, segment_id long, _ts long, id long, v array<float>, s string")
    base = str(tmp_path)
    column_log.write_files(column_log.encode_segments(df, SCHEMA, 7), base, 7)
    dd = spark.createDataFrame([(p, 99, str(k), t) for p, t, k in dels], "partition_id long, segment_id long, pk string, ts long")
    column_log.write_files(column_log.encode_deletes(dd, 7), base, 7, "delta_log")
    live = plans.read_collection(spark, base, SCHEMA, 7, keep_system=True)
    assert sorted((x.partition_id, x._ts, x.id) for x in live.collect()) == model(rows, dels)
    one = plans.read_collection(spark, base, SCHEMA, 7, partitions=[2], fields=["id"])
    assert one.columns == ["id"] and sorted(x.id for x in one.collect()) == sorted(k for p, _, k in model(rows, dels) if p == 2)
    timeless = plans.read_collection(spark, base, SCHEMA, 7, ignore_ts=True, keep_system=True)
    assert sorted((x.partition_id, x._ts, x.id) for x in timeless.collect()) == model([(p, -1, k) for p, _, k in rows], dels) or timeless.count() <= live.count()


def test_backup_metadata(spark, tmp_path):
    tree = {
        "id": "1", "unknown": 3, "collection_backups": [{"collection_id": 7, "collection_name": "c", "schema": {"fields": [
            {"name": "RowID", "data_type": "Int64"}, {"fieldID": 100, "name": "id", "data_type": 5, "is_primary_key": True},
            {"fieldID": 101, "name": "v", "data_type": "FloatVector", "type_params": [{"key": "dim", "value": "2"}]}]},
            "partition_backups": [{"partition_id": 1, "segment_backups": [{"segment_id": 11, "num_of_rows": 5, "binlogs": [{"binlogs": [{"log_path": "a", "log_size": 3}]}, {"fieldID": 100, "binlogs": [{"log_path": "b", "log_size": 4}]}]}, {"segment_id": 12, "is_l0": True}]}],
            "l0_segments": [{"segment_id": 13}]}, {"collection_id": 8, "collection_name": "empty", "schema": {"fields": [{"fieldID": 100, "name": "id", "data_type": 5, "is_primary_key": True}]}}],
    }
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta/full_meta.json").write_text(json.dumps(tree, indent=1))
    (tmp_path / "meta/segment_meta.json").write_text(json.dumps({"infos": [{"segment_id": 11}, {"segment_id": 12}]}))
    b = backup.read_backup(spark, str(tmp_path))
    s = backup.segments(b)
    assert sorted((r.partition_id, r.segment_id, r.num_of_rows, r.is_l0, r.scope) for r in s.collect()) == [(-1, 13, 0, True, "collection"), (1, 11, 5, False, "partition"), (1, 12, 0, True, "partition")]
    assert sorted((r.field_id, r.log_path, r.log_size) for r in backup.log_files(s).collect()) == [(0, "a", 3), (100, "b", 4)]
    schema = backup.collection_schema(b, "c")
    assert [(f.name, f.type, f.dim) for f in schema.fields] == [("id", FieldType.INT64, 0), ("v", FieldType.FLOAT_VECTOR, 2)] and schema.primary.name == "id"
    with pytest.raises(ValueError):
        backup.collection_schema(b, "missing")
    assert backup.read_flat(spark, str(tmp_path), "segment").count() == 2
    assert plans.read_backup_collection(spark, str(tmp_path), "empty").count() == 0


def test_index_event():
    raw = struct.pack("<iqqqq", 2, 5, 50, 6, 60)
    assert codec.read_index_event(raw) == [(5, 50), (6, 60)]
    raw = struct.pack("<ii", 1, 2) + b"ab" + struct.pack("<q", 9)
    assert codec.read_index_event(raw, text_keys=True) == [("ab", 9)]


def test_restore_into_a_store(spark, tmp_path):
    from lakevec.catalog import Catalog

    base = str(tmp_path / "b")
    df = spark.createDataFrame([(1, 11, 5, i, [float(i), 0.0], "x") for i in range(6)], "partition_id long, segment_id long, _ts long, id long, v array<float>, s string")
    column_log.write_files(column_log.encode_segments(df, SCHEMA, 7), f"{base}/binlogs", 7, nested=True)
    dels = spark.createDataFrame([(1, 12, "2", 9), (-1, 13, "3", 9), (-1, 13, "4", 1)], "partition_id long, segment_id long, pk string, ts long")
    column_log.write_files(column_log.encode_deletes(dels, 7), f"{base}/binlogs", 7, "delta_log", nested=True)
    fields = [{"fieldID": f.field_id, "name": f.name, "data_type": int(f.type), "is_primary_key": f.primary, "type_params": [{"key": "dim", "value": str(f.dim)}]} for f in SCHEMA.fields]
    tree = {"collection_backups": [{"collection_id": 7, "collection_name": "c", "schema": {"fields": fields}, "partition_backups": [{"partition_id": 1, "segment_backups": [{"segment_id": 11}, {"segment_id": 12, "is_l0": True}]}], "l0_segments": [{"segment_id": 13}]}]}
    (tmp_path / "b/meta").mkdir()
    (tmp_path / "b/meta/full_meta.json").write_text(json.dumps(tree))
    assert plans.restore(spark, base, "c", f"{tmp_path}/store") == 4
    assert sorted(r.id for r in Catalog(spark, f"{tmp_path}/store").read("default", "c").collect()) == [0, 1, 4, 5]
    assert [r.pk for r in plans.backup_deletes(spark, base, "c").collect()] == ["2"]
    assert sorted(r.pk for r in plans.backup_deletes(spark, base, "c", "collection").collect()) == ["3", "4"]
    side = spark.createDataFrame([(0, "zero")], "id long, name string")
    plans.backup_to_parquet(spark, base, "c", f"{tmp_path}/out", side, files=1)
    assert sorted((r.id, r.name) for r in spark.read.parquet(f"{tmp_path}/out").select("id", "name").collect()) == [(0, "zero"), (1, None), (4, None), (5, None)]


def test_rows_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", None), (2, None, [1.0])], "id long, s string, v array<double>")
    sink.write_rows(df.repartition(2), f"{tmp_path}/j")
    for f in (tmp_path / "j").glob("*.txt"):
        json.loads(f.read_text())
    assert sorted(map(str, rows_json.read_rows(spark, f"{tmp_path}/j", df.schema).collect())) == sorted(map(str, df.collect()))
    assert rows_json.read_rows(spark, f"{tmp_path}/j").count() == 2
    sink.write_rows(df.limit(0).coalesce(1), f"{tmp_path}/none")
    assert rows_json.read_rows(spark, f"{tmp_path}/none", df.schema).count() == 0
    df.write.json(f"{tmp_path}/lines")
    assert rows_json.read_rows(spark, f"{tmp_path}/lines", wrapped=False).count() == 2
    with pytest.raises(ValueError):
        rows_json.read_rows(spark, "x", sampling=0)


def test_paths(spark, tmp_path):
    for n in ("b.parquet", "a.parquet", "_x.parquet", ".y.parquet", "c.json"):
        (tmp_path / n).write_text("")
    assert [p.rsplit("/", 1)[1] for p in storage.list_files(spark, str(tmp_path), ".parquet")] == ["a.parquet", "b.parquet"]
    assert len(storage.glob_files(spark, f"{tmp_path}/?.parquet")) == 2
    assert storage.scheme_of("s3a://b/k") == "s3a" and storage.scheme_of("/x") == "file"
    assert storage.without_bucket("s3a://b/k/l") == "k/l" and storage.for_import("s3a://b/k") == "s3://b/k"


def test_large_delete_logs_have_several_files(spark, tmp_path):
    """A segment's deletes are in files of at most so many rows, even those of one key and time; small ones have one file."""
    hot = spark.range(3000).select(F.lit(1).cast("long").alias("partition_id"), F.lit(5).cast("long").alias("segment_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("pk"), F.when(F.col("id") % 3 == 0, 8).otherwise(F.col("id") * 10).alias("ts"))
    small = spark.createDataFrame([(-1, 6, 3, 30), (-1, 6, None, 31), (-1, 7, 4, 40)], "partition_id long, segment_id long, pk long, ts long")
    both = hot.unionByName(small).repartition(3)
    files = column_log.encode_deletes(both, 7, most_rows=200)
    made = column_log.write_files(files, str(tmp_path), 7, "delta_log")
    there = sorted((tmp_path / "delta_log/7").glob("*/*/*"))
    assert made == len(there) and [str(p.relative_to(tmp_path / "delta_log/7")) for p in there if p.parts[-3] == "-1"] == ["-1/6/0", "-1/7/0"]
    sizes = {p.name: len(codec.delete_rows(p.read_bytes())[0]) for p in there if p.parts[-3] == "1"}
    assert sum(sizes.values()) == 3000 and max(sizes.values()) <= 200 and len(sizes) < 40
    of = codec.read_descriptor(there[0].read_bytes())
    assert (of.collection_id, of.field_id, of.payload_type) == (7, 0, int(FieldType.STRING))
    rows = lambda x: sorted((str(r.pk), r.ts, r.partition_id, r.segment_id) for r in x.select("pk", "ts", "partition_id", "segment_id").collect())
    assert rows(logs.read_deletes(spark, f"{tmp_path}/delta_log/7")) == rows(both)
    assert rows(logs.decode_deletes(logs.files(spark, f"{tmp_path}/delta_log/7"))) == rows(both)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # numbers are dealt, texts are made after


def test_deletes_are_read_in_parts():
    """No more rows than asked for are in memory at a time, over events of all forms."""
    texts = pa.table({"val": [f'{{"pk":{i},"ts":{i + 5},"pkType":5}}' for i in range(1000)]})
    odd = pa.table({"val": ['{"pk":1,"ts":2,"pkType":5}', '{"pk":"x","ts":3}', '{"ts":4}', None, '{"pk":1.50,"ts":7}', '{"pk":-0,"ts":6}', '{"pk":123456789012345678901234567890,"ts":9}']})
    data = codec.encode_events([(codec.DELETE, texts), (codec.DELETE, odd), (codec.DELETE, pa.table({"pk": [5, None], "ts": [None, 4]}))], of())
    parts = list(codec.delete_parts(io.BytesIO(data), len(data), 64))
    assert max(len(k) for _, k, _ in parts) <= 64
    got = [x for _, k, t in parts for x in zip(k.to_pylist(), t.to_pylist(), strict=True)]
    end = of().end_ts
    assert got == [(str(i), i + 5) for i in range(1000)] + [("1", 2), ("x", 3), (None, 4), (None, end), ("1.5", 7), ("0", 6), ("123456789012345678901234567890", 9), ("5", end), (None, 4)]
