"""The schema of logs as their own footers tell it: types of all versions folded to the narrowest that holds them all.

Headers and footers are read in tasks, a row for each file; the types of a field, of which there are few, come to the driver.
Files that aren't logs or are cut short are rows with an error: they fail the fold, or are passed over with their segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..types import CollectionSchema, Field, FieldType
from . import codec, logs

FILES = "path string, partition_id long, segment_id long, field_id long, type int, width int, rows long, error string"
_INTEGERS = (FieldType.INT8, FieldType.INT16, FieldType.INT32, FieldType.INT64)
_FLOATS = (FieldType.FLOAT, FieldType.DOUBLE)
#: Whole numbers that single precision holds exactly; wider ones become double.
_SMALL = _INTEGERS[:2]
_VECTOR_BYTES = {FieldType.FLOAT_VECTOR: 4, FieldType.FLOAT16_VECTOR: 2, FieldType.BFLOAT16_VECTOR: 2, FieldType.BINARY_VECTOR: 1}


def widened(a: FieldType, b: FieldType) -> FieldType:
    """The narrowest type that holds the values of both; ValueError if there is none. Whole numbers widen to longer ones,
    with floats to float or double (64-bit ones to double, as readers of such columns do), texts to VARCHAR."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS or a in _FLOATS and b in _FLOATS:
        return max(a, b)
    if {a, b} <= {*_INTEGERS, *_FLOATS}:
        whole, real = (a, b) if a in _INTEGERS else (b, a)
        return real if whole in _SMALL else FieldType.DOUBLE
    if {a, b} <= {FieldType.STRING, FieldType.VARCHAR}:
        return FieldType.VARCHAR
    raise ValueError(f"{a.name} and {b.name} have no common type")


def read_footers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """FILES below ``paths`` (.../{partition}/{segment}/{field}/{file}), by their headers and footers. ``width`` is the number
    of bytes of fixed-size values; ``error`` says why a file can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                kind = width = rows = error = None
                system, inner = storage.worker_fs(path)
                try:
                    with system.open_input_file(inner) as f:
                        head, footers = codec.scan(f, size)
                    kind, rows = head.payload_type, sum(m.num_rows for _, m in footers)
                    if not footers and size > head.first_event:
                        raise ValueError("it ends within an event")
                    width = max((m.schema.column(0).length or 0 for _, m in footers if m.num_columns), default=0)
                except (ValueError, OSError, pa.ArrowException, KeyError) as e:  # what a damaged file makes of the decoders
                    error = f"{type(e).__name__}: {e}"[:300]
                out.append((path, kind, width, rows, error))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)], names=["path", "type", "width", "rows", "error"])

    part = lambda i: F.regexp_extract("path", r"(\d+)/(\d+)/(?:\2/)?(\d+)/([^/]+)$", i).try_cast("long")
    found = logs.listed(spark, paths).mapInArrow(run, "path string, type int, width int, rows long, error string")
    return found.select("path", part(1).alias("partition_id"), part(2).alias("segment_id"), part(3).alias("field_id"), "type", "width", "rows", "error")


def merge_schema(files: DataFrame, names: dict[int, str], primary: int, skip_corrupt: bool = False, name: str = "merged") -> CollectionSchema:
    """The schema of all versions in ``files`` (``read_footers``): ``names`` of fields by id, system fields left out. A field
    that some segment hasn't got may be null; so may all but the primary key. ValueError for files that can't be read
    (unless ``skip_corrupt``), types without a common one and vectors of different lengths."""
    if not skip_corrupt:
        bad = files.where("error IS NOT NULL").select("path", "error").limit(3).collect()
        if bad:
            raise ValueError("no schema: " + "; ".join(f"{b['path']}: {b['error']}" for b in bad))
    good = _whole(files).where(F.col("field_id").isin(list(names)))
    fields = []
    for r in good.groupBy("field_id").agg(F.collect_set("type").alias("types"), F.collect_set(F.when(F.col("rows") > 0, F.col("width"))).alias("widths")).orderBy("field_id").collect():  # a row for each field
        kind, widths = reduce(widened, sorted(FieldType(t) for t in r["types"])), set(r["widths"]) - {0}
        if kind.is_vector and len(widths) > 1:
            raise ValueError(f"{names[r['field_id']]} has vectors of {sorted(widths)} bytes")
        dim = (max(widths, default=0) * 8 if kind == FieldType.BINARY_VECTOR else max(widths, default=0) // _VECTOR_BYTES[kind]) if kind in _VECTOR_BYTES else 0
        fields.append(Field(names[r["field_id"]], kind, r["field_id"], dim=dim, primary=r["field_id"] == primary, nullable=r["field_id"] != primary))
    return CollectionSchema(name, tuple(fields))


def _whole(files: DataFrame) -> DataFrame:
    """The files of segments without a damaged file."""
    bad = files.where("error IS NOT NULL").select("partition_id", "segment_id").distinct()
    return files.join(bad, ["partition_id", "segment_id"], "left_anti")


def read_merged(spark: SparkSession, paths: str, names: dict[int, str], primary: int, skip_corrupt: bool = False, with_system: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows in the merged schema, damaged files). A segment with a damaged file is passed over as a whole, since its rows
    would be half; narrower versions are widened, and what a version hasn't got is null."""
    files = storage.materialise(read_footers(spark, paths), "footers")
    schema = merge_schema(files, names, primary, skip_corrupt)
    segments = _whole(files).select("partition_id", "segment_id").distinct()
    return logs.read_segments(spark, paths, schema, with_system=with_system, segments=segments), files.where("error IS NOT NULL").select("path", "error")
