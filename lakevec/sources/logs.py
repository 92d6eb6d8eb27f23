"""Log files as DataFrames.

``binaryFile`` lists, prunes and deals the files. Where Python workers know the store, only paths are listed and shuffled:
a task opens the files of its segments itself, and footers and headers are read without the values between them. On
stores that only Spark can open, contents come from Spark's reader. A segment's columns are separate files of equal
length; they are brought together by segment, once, and zipped by position in one task, so no column is joined to
another. The task reads all columns in step, a batch of rows at a time, so its memory doesn't grow with the segment.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..types import CollectionSchema, Field, TS_FIELD
from . import codec

META = (
    "path string, collection_id long, partition_id long, segment_id long, field_id long, start_ts long, end_ts long, payload_type int, "
    "post_header_lengths array<int>, extras map<string,string>, events int, rows long, bytes long"
)
STATS = "path string, segment_id long, field_id long, column string, rows long, nulls long, min string, max string"
#: Rows of a segment that are in a worker's memory at a time.
BATCH_ROWS = 8192
DELETES = "pk string, ts long, collection_id long, partition_id long, segment_id long"


def files(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, content) of all files below ``paths``; ``pattern`` is a glob for names."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).select("path", "content")


def listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length) of all files below ``paths``, none of which is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")


def _scanned(spark: SparkSession, paths: str | list[str], step, schema: str) -> DataFrame:
    """``step(path, size, descriptor, footers)`` of each file."""

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                system, inner = storage.worker_fs(path)
                with system.open_input_file(inner) as f:
                    yield step(path, size, *codec.scan(f, size))

    def given(path: str, content: bytes):
        return step(path, len(content), *codec.scan(io.BytesIO(content), len(content)))

    if all(storage.worker_can_open(x) for x in ([paths] if isinstance(paths, str) else paths)):
        return listed(spark, paths).mapInArrow(here, schema)
    return files(spark, paths).mapInArrow(_decode(given), schema)


def _decode(step):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                out = step(path, content)
                if out is not None:
                    yield out

    return run


def read_column(spark: SparkSession, paths: str | list[str], field: Field) -> DataFrame:
    """(path, ordinal, value) of single-column files, in the type of ``field``. Ordinals count a file's rows from 0."""

    def step(path: str, content: bytes) -> pa.RecordBatch | None:
        parts = [codec.from_storage(codec.column_of(e), field) for e in codec.read_events(content) if e.kind == codec.INSERT]
        values = pa.concat_arrays(parts) if parts else pa.array([], codec.arrow_type(field))
        return pa.RecordBatch.from_arrays([pa.array([path] * len(values), pa.string()), pa.array(range(len(values)), pa.int64()), values], names=["path", "ordinal", "value"])

    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("value", field.spark_type())])
    return files(spark, paths).mapInArrow(_decode(step), schema)


def read_meta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row for each file: what its descriptor says, its events and rows. Only headers and footers are read."""

    def step(path: str, size: int, d: codec.Descriptor, footers) -> pa.RecordBatch:
        row = {
            "path": path, "collection_id": d.collection_id, "partition_id": d.partition_id, "segment_id": d.segment_id, "field_id": d.field_id,
            "start_ts": d.start_ts, "end_ts": d.end_ts, "payload_type": d.payload_type, "post_header_lengths": list(d.post_header_lengths),
            "extras": [(k, str(v)) for k, v in d.extras.items()], "events": len(footers), "rows": sum(m.num_rows for _, m in footers), "bytes": size,
        }
        return pa.RecordBatch.from_pylist([row], _META)

    return _scanned(spark, paths, step, META)


_META = pa.schema(
    [("path", pa.string()), *[(k, pa.int64()) for k in ("collection_id", "partition_id", "segment_id", "field_id", "start_ts", "end_ts")], ("payload_type", pa.int32()),
     ("post_header_lengths", pa.list_(pa.int32())), ("extras", pa.map_(pa.string(), pa.string())), ("events", pa.int32()), ("rows", pa.int64()), ("bytes", pa.int64())]
)
_STATS = pa.schema([("path", pa.string()), ("segment_id", pa.int64()), ("field_id", pa.int64()), ("column", pa.string()), ("rows", pa.int64()), ("nulls", pa.int64()), ("min", pa.string()), ("max", pa.string())])


def read_stats(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows, nulls, least and largest value of each file's columns from the Parquet footers; no values are read.

    A value is null where a footer has no statistics.
    """

    def step(path: str, size: int, d: codec.Descriptor, footers) -> pa.RecordBatch:
        rows = []
        for _, meta in footers:
            for g in range(meta.num_row_groups):
                for c in range(meta.num_columns):
                    column = meta.row_group(g).column(c)
                    s = column.statistics
                    low, high = (str(s.min), str(s.max)) if s is not None and s.has_min_max else (None, None)
                    rows.append({"path": path, "segment_id": d.segment_id, "field_id": d.field_id, "column": column.path_in_schema, "rows": meta.row_group(g).num_rows, "nulls": s.null_count if s is not None and s.has_null_count else None, "min": low, "max": high})
        return pa.RecordBatch.from_pylist(rows, _STATS)

    return _scanned(spark, paths, step, STATS)


def read_deletes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(pk text, ts, ids) of delete logs: files, folders or globs. FileNotFoundError where a glob matches nothing."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = [x for p in paths for x in (storage.glob_files(spark, p) if re.search(r"[*?]", p) else [p])]
    if not found:
        return spark.createDataFrame([], DELETES)
    if not all(storage.worker_can_open(x) for x in found):
        return decode_deletes(files(spark, found))

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                system, inner = storage.worker_fs(path)
                with system.open_input_file(inner) as f:
                    yield from _delete_batches(f, size)

    return listed(spark, found).mapInArrow(here, DELETES)


def _delete_batches(file, size: int) -> Iterator[pa.RecordBatch]:
    for d, keys, stamps in codec.delete_parts(file, size, BATCH_ROWS):
        ids = [pa.array(np.full(len(keys), x), pa.int64()) for x in (d.collection_id, d.partition_id, d.segment_id)]
        yield pa.RecordBatch.from_arrays([keys, stamps, *ids], names=["pk", "ts", "collection_id", "partition_id", "segment_id"])


def decode_deletes(contents: DataFrame) -> DataFrame:
    """The same for rows (path, content), also of a stream."""

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                yield from _delete_batches(io.BytesIO(data), len(data))

    return contents.mapInArrow(given, DELETES)


def read_segments(
    spark: SparkSession, paths: str | list[str], schema: CollectionSchema, fields: list[str] | None = None, with_system: bool = True, nullable_missing: bool = True,
    segments: DataFrame | None = None,
) -> DataFrame:
    """The rows of segments below ``paths``: partition_id, segment_id, _ordinal, _ts and the fields.

    Paths end in ``.../{partition}/{segment}/{field}/{file}``; a field's files follow each other by name. Only the
    folders of the wanted ``fields`` are opened, and of the wanted ``segments`` (partition_id, segment_id) if they are
    given: their paths are picked before any file is opened. ValueError where two fields of a segment have
    different lengths. A field without a folder is null, unless it may not be.
    """
    wanted = [schema.by_name(n) for n in (fields or [f.name for f in schema.fields])]
    ids = [f.field_id for f in wanted] + ([TS_FIELD] if with_system else [])
    part = lambda i: F.regexp_extract("path", rf"(\d+)/(\d+)/(?:\2/)?(\d+)/([^/]+)$", i)
    by_path = all(storage.worker_can_open(x) for x in ([paths] if isinstance(paths, str) else paths))
    rows = listed(spark, paths).withColumn("content", F.col("path")) if by_path else files(spark, paths)
    rows = rows.select(part(1).try_cast("long").alias("partition_id"), part(2).try_cast("long").alias("segment_id"), part(3).try_cast("long").alias("field_id"), part(4).alias("file"), "content")
    rows = rows.where(F.col("field_id").isin(ids))
    if segments is not None:
        rows = rows.join(segments.select("partition_id", "segment_id"), ["partition_id", "segment_id"], "left_semi")
    system = [T.StructField("_ts", T.LongType())] if with_system else []
    out = T.StructType(
        [T.StructField("partition_id", T.LongType()), T.StructField("segment_id", T.LongType()), T.StructField("_ordinal", T.LongType()), *system]
        + [T.StructField(f.name, f.spark_type()) for f in wanted]
    )
    ts_field = Field("_ts", codec.FieldType.INT64, TS_FIELD)
    columns = ([ts_field] if with_system else []) + wanted

    def zipped(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, segment = (k.as_py() for k in key)
        content: dict[int, list] = {}
        found = [x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("field_id", "file", "content")), strict=True)]
        for field_id, _, data in sorted(found, key=lambda x: (x[0], _by_name(x[1]))):
            content.setdefault(field_id, []).append(data)
        for f in columns:
            if f.field_id not in content and not (f.nullable and nullable_missing) and f is not ts_field:
                raise ValueError(f"segment {segment} has no column {f.name}, which may not be null")
        there = {f.name: _Column(content[f.field_id], f, by_path) for f in columns if f.field_id in content}
        done = 0
        while ready := {name: c.ready() for name, c in there.items()}:
            n = min(ready.values())
            if not n:
                if any(ready.values()):
                    raise ValueError(f"the columns of segment {segment} have different lengths: after {done} rows {sorted(k for k, v in ready.items() if v)} go on")
                break
            head = [pa.array(np.full(n, x), pa.int64()) if x is not None else pa.nulls(n, pa.int64()) for x in (partition, segment)]
            values = [there[f.name].take(n) if f.name in there else pa.nulls(n, codec.arrow_type(f)) for f in columns]
            yield pa.RecordBatch.from_arrays([*head, pa.array(np.arange(done, done + n)), *values], names=out.names)
            done += n

    return rows.groupBy("partition_id", "segment_id").applyInArrow(zipped, out)


class _Column:
    """The values of a column's files, one file after another, some at a time."""

    def __init__(self, files: list, f: Field, by_path: bool):
        self.parts, self.rest = self._read(files, f, by_path), None

    @staticmethod
    def _read(files: list, f: Field, by_path: bool) -> Iterator[pa.Array]:
        for data in files:
            if not by_path:
                yield from codec.column_parts(io.BytesIO(data), len(data), f, BATCH_ROWS)
                continue
            system, inner = storage.worker_fs(data)
            with system.open_input_file(inner) as opened:
                yield from codec.column_parts(opened, opened.size(), f, BATCH_ROWS)

    def ready(self) -> int:
        """How many values can be taken now, 0 at the end."""
        while not self.rest:
            self.rest = next(self.parts, None)
            if self.rest is None:
                return 0
        return len(self.rest)

    def take(self, n: int) -> pa.Array:
        out, self.rest = self.rest.slice(0, n), self.rest.slice(n)
        return out


def _by_name(name: str) -> tuple:
    return (0, int(name), "") if name.isdigit() else (1, 0, name)
