"""Collections as column logs: a folder per segment and field, a file per segment and field; delete logs: a folder per segment,
files of a bounded number of rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..sources import codec
from ..types import CollectionSchema, Field, FieldType, ROW_ID_FIELD, TS_FIELD

_FILE = "partition_id long, segment_id long, field_id long, content binary"
_NUMBERED = "partition_id long, segment_id long, field_id long, file long, content binary"
#: Deletes that one file has at most, which is what a task holds of them.
DELETE_ROWS = 200_000
#: How files are staged: they are compressed already, and pages and row groups end by their bytes, however few files that is.
_STAGED = {"compression": "none", "parquet.page.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}


def encode_segments(rows: DataFrame, schema: CollectionSchema, collection_id: int) -> DataFrame:
    """(partition_id, segment_id, field_id, content): the files of all segments of ``rows``, which have partition_id,
    segment_id, _ts and the schema's fields. A segment is one task's work and one file per field."""
    fields = [Field("_row_id", FieldType.INT64, ROW_ID_FIELD), Field("_ts", FieldType.INT64, TS_FIELD), *schema.fields]

    def encode(key, table):
        partition, segment = (k.as_py() for k in key)
        stamps = table.column("_ts").to_pylist()
        out = []
        for f in fields:
            values = pa.array(range(len(table)), pa.int64()) if f.field_id == ROW_ID_FIELD else pa.concat_arrays(table.column(f.name).chunks)
            of = codec.Descriptor(collection_id, partition, segment, f.field_id, min(stamps, default=0), max(stamps, default=0), int(f.type))
            out.append(codec.encode(pa.table({"val": codec.to_storage(values, f)}), of))
        n = len(out)
        return pa.table({"partition_id": pa.array([partition] * n, pa.int64()), "segment_id": pa.array([segment] * n, pa.int64()), "field_id": pa.array([f.field_id for f in fields], pa.int64()), "content": pa.array(out, pa.binary())})

    columns = ["partition_id", "segment_id", "_ts", *[f.name for f in schema.fields]]
    return rows.select(*columns).groupBy("partition_id", "segment_id").applyInArrow(encode, _FILE)


def encode_deletes(deletes: DataFrame, collection_id: int, pk_type: FieldType = FieldType.INT64, most_rows: int = DELETE_ROWS) -> DataFrame:
    """(partition_id, segment_id, field_id, file, content) of delete logs out of (partition_id, segment_id, pk, ts).

    A segment with more than ``most_rows`` deletes has several files, dealt by key and time (with room, as these aren't quite
    even), whose work is that of several tasks; a task holds one file's rows at a time, even where most deletes are of one
    key and time.
    """
    rows = deletes.select("partition_id", "segment_id", "pk", "ts")
    large = rows.groupBy("partition_id", "segment_id").count().where(F.col("count") > most_rows)
    large = large.select(F.col("partition_id").alias("_p"), F.col("segment_id").alias("_s"), F.ceil(F.col("count") * 1.25 / most_rows).alias("_files"))
    known = F.broadcast(rows.sparkSession.createDataFrame(large.collect(), large.schema))  # a row for most_rows deletes at most
    same = F.col("partition_id").eqNullSafe(F.col("_p")) & F.col("segment_id").eqNullSafe(F.col("_s"))
    dealt = rows.join(known, same, "left").withColumn("_files", F.coalesce("_files", F.lit(1)))
    key = ["partition_id", "segment_id", "_files", "_file"]
    dealt = dealt.select("partition_id", "segment_id", "_files", F.pmod(F.xxhash64("pk", "ts"), F.col("_files")).alias("_file"), "pk", "ts").repartition(*key)
    record = F.to_json(F.struct("pk", "ts", F.lit(int(pk_type)).alias("pkType"))).alias("value")  # after the shuffle, which numbers are smaller for

    def encode(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, segment, files, file = (k.as_py() for k in key)

        def made(table: pa.Table, number: int) -> pa.RecordBatch:
            least, most = (x.as_py() or 0 for x in pc.min_max(table.column("ts")).values())
            of = codec.Descriptor(collection_id, partition, segment, 0, least, most, int(FieldType.STRING))
            content = codec.encode(table.select(["value"]).rename_columns(["val"]), of, codec.DELETE)
            values = (partition, segment, 0, number)
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in values], pa.array([content], pa.binary())], names=["partition_id", "segment_id", "field_id", "file", "content"])

        kept, n = [], 0
        for batch in batches:
            while batch.num_rows:
                kept.append(batch.select(["ts", "value"]).slice(0, most_rows - n))
                batch, n = batch.slice(most_rows - n), n + kept[-1].num_rows
                if n == most_rows:
                    yield made(pa.Table.from_batches(kept), file)
                    kept, n, file = [], 0, file + files
        if n:
            yield made(pa.Table.from_batches(kept), file)

    return dealt.select(*key, "ts", record).groupBy(*key).applyInArrow(encode, _NUMBERED)


def write_files(files: DataFrame, base: str, collection_id: int, kind: str = "insert_log", nested: bool = False) -> int:
    """Put the files below ``base``/``kind``; their number.

    Tasks write them through the file system of ``base`` (any that Python workers have; ValueError for others), each
    under a hidden name before it gets its own, so that a lost task leaves no half file and a repeated one the same file.
    ``nested`` repeats the segment's folder, as backups have it. A file's name is its number ``file``, if there is one, or 0.
    """
    if not storage.worker_can_open(base):
        raise ValueError(f"column logs can't be written to {base}")
    place = storage.scratch(files.sparkSession, "files")
    files.write.options(**_STAGED).parquet(place)
    staged = files.sparkSession.read.schema(files.schema).parquet(place)
    target = F.concat_ws("/", F.lit(base.rstrip("/")), F.lit(kind), F.lit(str(collection_id)), "partition_id", "segment_id", *(["segment_id"] if nested else []), *(["field_id"] if kind == "insert_log" else []), F.col("file").cast("string") if "file" in staged.columns else F.lit("0"))
    put = staged.select(target.alias("path"), "content")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                storage.put(path.as_py(), content.as_py())
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return put.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
