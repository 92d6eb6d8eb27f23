"""Segments whose columns are cut into events and files at different rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakevec import storage
from lakevec.sources import codec, logs
from lakevec.types import CollectionSchema, Field, FieldType

KEY, TEXT, VECTOR = Field("k", FieldType.INT64, 100, primary=True, nullable=False), Field("t", FieldType.VARCHAR, 101, max_length=64), Field("v", FieldType.FLOAT_VECTOR, 102, dim=4)
SCHEMA = CollectionSchema("c", (KEY, TEXT, VECTOR))
ROWS = 2 * logs.BATCH_ROWS + 1234


def _columns(n):
    ids = np.arange(n)
    return {
        1: pa.array(ids + 7), 100: pa.array(ids), 101: pa.array([None if i % 5 == 0 else f"t{i}" for i in ids]),
        102: pa.array([np.full(4, i, "<f4").tobytes() for i in ids], pa.binary(4 * 4)),
    }


def _write(base, columns, cuts, segment=11):
    """Files of each column; ``cuts`` has for each field the rows at which a new event (or file, where negative) begins."""
    for field, values in columns.items():
        files, at = [[]], 0
        for cut in [*cuts.get(field, []), len(values)]:
            files[-1].append((codec.INSERT, pa.table({"val": values.slice(at, abs(cut) - at)})))
            at = abs(cut)
            if cut < 0:
                files.append([])
        for i, events in enumerate(files):
            storage.put(f"{base}/insert_log/1/5/{segment}/{field}/{i}", codec.encode_events(events, codec.Descriptor(1, 5, segment, field, 0, 9, 5)))


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_columns_are_read_in_step(spark, tmp_path, scheme):
    _write(tmp_path, _columns(ROWS), {100: [1, 9000], 101: [-5000, 5000, 12345], 102: [8192, -8193, 8194]})
    _write(tmp_path, _columns(3), {}, segment=12)
    rows = logs.read_segments(spark, f"{scheme}{tmp_path}/insert_log/1", SCHEMA)
    found = rows.groupBy("segment_id").agg(
        F.count("*").alias("n"), F.count_distinct("_ordinal").alias("ordinals"), F.count("t").alias("texts"),
        F.count_if((F.col("k") == F.col("_ordinal")) & (F.col("_ts") == F.col("k") + 7) & (F.coalesce("t", F.concat(F.lit("t"), "k")) == F.concat(F.lit("t"), "k")) & (F.col("v")[3] == F.col("k"))).alias("right"),
    )
    assert {tuple(r) for r in found.collect()} == {(11, ROWS, ROWS, ROWS - (ROWS + 4) // 5, ROWS), (12, 3, 3, 2, 3)}
    assert logs.read_segments(spark, f"{scheme}{tmp_path}/insert_log/1", SCHEMA, ["t"], with_system=False).where("segment_id = 12").orderBy("_ordinal").select("t").collect() == [(None,), ("t1",), ("t2",)]


def test_batches_are_bounded(tmp_path):
    _write(tmp_path, _columns(ROWS), {})
    column = logs._Column([f"{tmp_path}/insert_log/1/5/11/100/0"], KEY, True)
    sizes = []
    while n := column.ready():
        sizes.append(n)
        column.take(n)
    assert sum(sizes) == ROWS and max(sizes) == logs.BATCH_ROWS


@pytest.mark.parametrize("short", [0, 1, logs.BATCH_ROWS, ROWS - 1])
def test_unequal_columns_raise(spark, tmp_path, short):
    columns = _columns(ROWS)
    _write(tmp_path, columns | {101: columns[101].slice(0, short)}, {})
    with pytest.raises(Exception, match="different lengths"):
        logs.read_segments(spark, f"{tmp_path}/insert_log/1", SCHEMA).count()


def test_segments_without_rows(spark, tmp_path):
    _write(tmp_path, _columns(0), {})
    assert logs.read_segments(spark, f"{tmp_path}/insert_log/1", SCHEMA).count() == 0
