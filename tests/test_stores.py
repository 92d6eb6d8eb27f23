"""Paths that tasks open themselves: footers alone, large events, stores that can't be written."""

import io

import pyarrow as pa
import pytest

from lakevec import storage
from lakevec.sinks import column_log
from lakevec.sources import codec, datasource, logs
from lakevec.types import Field, FieldType


class Counted(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        self.bytes += len(out)
        return out


def test_scan_reads_headers_and_footers_only():
    table = pa.table({"val": pa.array(range(200_000), pa.int64())})
    data = codec.encode(table, codec.Descriptor(1, 2, 3, 100, 0, 9, int(FieldType.INT64)))
    file = Counted(data)
    of, footers = codec.scan(file, len(data))
    assert (of.segment_id, [m.num_rows for _, m in footers]) == (3, [200_000])
    assert file.bytes < 80_000 < len(data) // 4


def test_large_columns_become_several_events(monkeypatch):
    monkeypatch.setattr(codec, "EVENT_BYTES", 1000)
    data = codec.encode(pa.table({"val": pa.array(range(1000), pa.int64())}), codec.Descriptor(1, 2, 3, 100, 0, 9, int(FieldType.INT64)))
    events = list(codec.read_events(data))
    assert len(events) > 5
    assert [x for e in events for x in codec.column_of(e).to_pylist()] == list(range(1000))
    empty = codec.encode(pa.table({"val": pa.array([], pa.int64())}), codec.Descriptor(1, 2, 3, 100, 0, 9, int(FieldType.INT64)))
    assert [len(codec.column_of(e)) for e in codec.read_events(empty)] == [0]


def test_what_cannot_be_written_raises(spark, tmp_path):
    datasource.register(spark)
    df = spark.range(3).withColumnRenamed("id", "val")
    with pytest.raises(Exception, match="can't open"):
        df.write.format("column_log").option("path", "madeup://bucket/x").mode("append").save()
    files = spark.createDataFrame([(1, 1, 100, bytearray(b"x"))], "partition_id long, segment_id long, field_id long, content binary")
    with pytest.raises(ValueError, match="can't be written"):
        column_log.write_files(files, "madeup://bucket/x", 7)


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_paths_of_workers(tmp_path, scheme):
    storage.put(f"{scheme}{tmp_path}/a/b", b"content")
    system, inner = storage.worker_fs(f"{scheme}{tmp_path}/a/b")
    assert inner == f"{tmp_path}/a/b" and system.open_input_stream(inner).read() == b"content"
    assert [x.name for x in (tmp_path / "a").iterdir()] == ["b"]


def test_contents_are_not_shuffled(spark, tmp_path):
    field = Field("v", FieldType.INT64, 101)
    for part in range(3):
        data = codec.encode(pa.table({"val": pa.array([part, 10 + part], pa.int64())}), codec.Descriptor(7, 1, 2, 101, 0, 9, int(FieldType.INT64)))
        storage.put(f"{tmp_path}/1/2/101/{part}", data)
    from lakevec.types import CollectionSchema

    rows = logs.read_segments(spark, str(tmp_path), CollectionSchema("c", (field,)), with_system=False)
    assert [r.v for r in rows.orderBy("_ordinal").collect()] == [0, 10, 1, 11, 2, 12]
    scan = next(x for x in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "binaryFile" in x or "FileScan" in x)
    assert "ReadSchema: struct<path:string>" in scan
