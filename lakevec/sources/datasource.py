"""``spark.read.format("collection" | "column_log" | "delete_log" | "log_meta" | "log_stats")``: the readers of ``logs`` as data sources.

These open files in the Python workers, by pyarrow's file systems (local, s3, gs, hdfs), one task per file. ``logs`` has
the same for stores that only Spark can open. Collections are read in parts of a file; give a schema of fewer columns
(``spark.read.schema``) and only those are read. Filters are not pushed down here: Spark 4.1 keeps what it pushed into a
Python source for later queries on the same frame, even for those without filters, which then lose rows.
``Catalog.read`` goes through Spark's own Parquet reader and pushes both down.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..types import Field, FieldType


#: Bytes of a file that one task reads.
SPLIT_BYTES = 128 << 20


def _files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files at ``path``: a file, a folder with all below it, or a folder and a pattern of names."""
    import posixpath
    from fnmatch import fnmatch

    from pyarrow import fs

    from lakevec.storage import worker_fs

    base, name = path, None
    if any(c in posixpath.basename(path) for c in "*?"):
        base, name = posixpath.split(path)
    system, inner = worker_fs(base)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(inner, info.size)]
    found = system.get_file_info(fs.FileSelector(inner, recursive=name is None))
    out = sorted((i.path, i.size) for i in found if i.type == fs.FileType.File and i.base_name[:1] not in "._" and (name is None or fnmatch(i.base_name, name)))
    if not out:
        raise FileNotFoundError(path)
    return out


def _read(base: str, path: str) -> bytes:
    from lakevec.storage import worker_fs

    with worker_fs(base)[0].open_input_stream(path) as f:
        return f.read()


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    """``rows`` makes the rows of a file out of its path and bytes, or, with ``footers``, of its headers and footers."""

    def __init__(self, path: str, rows, footers: bool = False):
        self.path, self.rows, self.footers = path, rows, footers

    def partitions(self):
        return [_File(p) for p, _ in _files(self.path)]

    def read(self, partition):
        if not self.footers:
            yield from self.rows(partition.path, _read(self.path, partition.path))
            return
        from lakevec.sources import codec
        from lakevec.storage import worker_fs

        with worker_fs(self.path)[0].open_input_file(partition.path) as f:
            yield from self.rows(partition.path, *codec.scan(f, f.size()))


class _Range(InputPartition):
    """The row groups of a file that begin at bytes ``first`` to ``last`` (exclusive)."""

    def __init__(self, path: str, first: int, last: int):
        super().__init__(path)
        self.path, self.first, self.last = path, first, last


def _begin(group) -> int:
    column = group.column(0)
    return column.dictionary_page_offset if column.has_dictionary_page and column.dictionary_page_offset else column.data_page_offset


class _TableReader(DataSourceReader):
    """Columns ``names`` of the Parquet files below ``path``, a task for each SPLIT_BYTES, whole row groups each."""

    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def partitions(self):
        return [_Range(p, i, i + SPLIT_BYTES) for p, size in _files(self.path) for i in range(0, max(size, 1), SPLIT_BYTES)]

    def read(self, partition):
        import pyarrow.parquet as pq

        from lakevec.storage import worker_fs

        with worker_fs(self.path)[0].open_input_file(partition.path) as f:
            file = pq.ParquetFile(f)
            groups = [file.metadata.row_group(i) for i in range(file.metadata.num_row_groups)]
            mine = [i for i, g in enumerate(groups) if partition.first <= _begin(g) < partition.last]
            if mine:
                yield from file.iter_batches(row_groups=mine, columns=self.names)


class ColumnLog(DataSource):
    """Options: path; fieldType (a name of FieldType), dim, element; column (the name, "val" unless given)."""

    @classmethod
    def name(cls) -> str:
        return "column_log"

    def _field(self) -> Field:
        o = self.options
        element = o.get("element")
        return Field(o.get("column", "val"), FieldType[o.get("fieldType", "INT64").upper()], int(o.get("fieldId", 100)), dim=int(o.get("dim", 0)), element=FieldType[element.upper()] if element else None)

    def schema(self) -> StructType:
        return StructType([self._field().struct_field()])

    def reader(self, schema):
        field = self._field()

        def rows(path: str, data: bytes):
            import pyarrow as pa

            from lakevec.sources import codec

            for event in codec.read_events(data):
                if event.kind == codec.INSERT:
                    yield pa.RecordBatch.from_arrays([codec.from_storage(codec.column_of(event), field)], names=[field.name])

        return _Reader(self.options["path"], rows)

    def writer(self, schema, overwrite: bool):
        return _ColumnLogWriter(self.options, self._field(), overwrite)


class _Written(WriterCommitMessage):
    def __init__(self, path: str | None, rows: int):
        self.path, self.rows = path, rows


class _Staged:
    """Files below ``folder`` under hidden names, on its own file system; commit gives them their names, abort removes
    them. ValueError for a store that Python workers can't open, before any row is written."""

    def __init__(self, folder: str):
        from lakevec.storage import worker_fs

        worker_fs(folder)
        self.folder = folder

    def place(self):
        from lakevec.storage import worker_fs

        return worker_fs(self.folder)

    def visible(self) -> list[str]:
        """The files that readers see now."""
        from pyarrow import fs

        system, folder = self.place()
        return [x.path for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.is_file and x.base_name[:1] not in "._"]

    def remove(self, paths: list[str]) -> None:
        for x in paths:
            self.place()[0].delete_file(x)

    def publish(self, message, name: str) -> None:
        system, inner = self.place()
        system.move(message.path, f"{inner}/{name}")

    def drop(self, messages) -> None:
        import contextlib

        for m in messages:
            if m and m.path:
                with contextlib.suppress(OSError):
                    self.place()[0].delete_file(m.path)


class _ColumnLogWriter(DataSourceWriter):
    """One file per task, staged under a hidden name; commit gives the files their names, abort removes them. An overwrite
    removes what was there once the new files have their names."""

    def __init__(self, options, field: Field, overwrite: bool = False):
        self.options, self.field, self.staged, self.overwrite = dict(options), field, _Staged(options["path"]), overwrite

    def write(self, rows):
        import uuid

        import pyarrow as pa

        from lakevec.sources import codec

        values = [r[0] for r in rows]
        if not values:
            return _Written(None, 0)
        o, f = self.options, self.field
        stored = codec.to_storage(pa.array(values, codec.arrow_type(f)), f)
        number = lambda k: int(o.get(k, 0))
        of = codec.Descriptor(number("collectionId"), number("partitionId"), number("segmentId"), f.field_id, number("startTs"), number("endTs"), int(f.type))
        system, folder = self.staged.place()
        system.create_dir(folder, recursive=True)
        path = f"{folder}/_staging_{uuid.uuid4().hex}"
        with system.open_output_stream(path) as out:
            out.write(codec.encode(pa.table({"val": stored}), of))
        return _Written(path, len(values))

    def commit(self, messages):
        old = self.staged.visible() if self.overwrite else []
        for i, m in enumerate(m for m in messages if m and m.path):
            self.staged.publish(m, f"{i:06d}_{m.path.rpartition('/')[2][9:17]}")
        self.staged.remove(old)

    def abort(self, messages):
        self.staged.drop(messages)


class DeleteLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "delete_log"

    def schema(self) -> str:
        return "pk string, ts long, collection_id long, partition_id long, segment_id long"

    def reader(self, schema):
        def rows(path: str, data: bytes):
            import io

            from lakevec.sources import codec

            for d, keys, stamps in codec.delete_parts(io.BytesIO(data), len(data), 8192):
                for key, ts in zip(keys.to_pylist(), stamps.to_pylist(), strict=True):
                    yield (key, ts, d.collection_id, d.partition_id, d.segment_id)

        return _Reader(self.options["path"], rows)


class LogMeta(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_meta"

    def schema(self) -> str:
        return "path string, collection_id long, partition_id long, segment_id long, field_id long, start_ts long, end_ts long, payload_type int, events int, rows long"

    def reader(self, schema):
        def rows(path: str, d, footers):
            yield (path, d.collection_id, d.partition_id, d.segment_id, d.field_id, d.start_ts, d.end_ts, d.payload_type, len(footers), sum(m.num_rows for _, m in footers))

        return _Reader(self.options["path"], rows, footers=True)


class LogStats(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_stats"

    def schema(self) -> str:
        return "path string, column string, rows long, nulls long, min string, max string"

    def reader(self, schema):
        def rows(path: str, d, footers):
            for _, meta in footers:
                for g in range(meta.num_row_groups):
                    for c in range(meta.num_columns):
                        column = meta.row_group(g).column(c)
                        s = column.statistics
                        ok = s is not None and s.has_min_max
                        yield (path, column.path_in_schema, meta.row_group(g).num_rows, s.null_count if s is not None else None, str(s.min) if ok else None, str(s.max) if ok else None)

        return _Reader(self.options["path"], rows, footers=True)


class Collection(DataSource):
    """Collections of the store at ``path``: appended to row batch by row batch, or read.

    Options are those of ``lakevec.options``. Writing makes the database, collection and partition if they aren't there;
    columns are bound by name; each task stages files of ``insertMaxBatchSize`` rows a row group, and commit makes all of
    them visible. An aborted job publishes nothing.
    """

    @classmethod
    def name(cls) -> str:
        return "collection"

    def _place(self):
        from lakevec.options import Options

        o = Options({k: v for k, v in self.options.items() if k.lower() != "path"})
        if not o["collection.name"]:
            raise ValueError("collection.name is missing")
        return o, f"{self.options['path'].rstrip('/')}/{o.database or 'default'}/{o['collection.name']}"

    def _stored(self):
        from pyarrow import fs

        from lakevec.storage import worker_fs
        from lakevec.types import CollectionSchema

        system, path = worker_fs(f"{self._place()[1]}/schema.json")
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as f:
            return CollectionSchema.loads(f.read().decode())

    def schema(self) -> StructType:
        stored = self._stored()
        if stored is None:
            raise ValueError(f"there is no collection {self._place()[0]['collection.name']}")
        return stored.to_struct()

    def reader(self, schema):
        o, folder = self._place()
        part = f"{folder}/data" + (f"/_partition={o['partition.name']}" if o["partition.name"] else "")
        return _TableReader(part, schema.fieldNames())

    def writer(self, schema, overwrite: bool):
        from lakevec.storage import put
        from lakevec.types import CollectionSchema

        o, folder = self._place()
        stored = self._stored()
        if stored is None:
            stored = CollectionSchema.from_struct(o["collection.name"], schema, o["collection.primaryKeyField"], o["collection.vectorField"], o.number("collection.vectorDim"), o.flag("collection.autoID"))
            put(f"{folder}/schema.json", stored.dumps().encode())
        missing = [f.name for f in stored.fields if f.name not in schema.fieldNames() and not f.auto_id and not f.nullable]
        if missing:
            raise ValueError(f"no column is named {missing[0]}")
        return _CollectionWriter(f"{folder}/data/_partition={o['partition.name'] or '_default'}", stored, o.number("insertMaxBatchSize"), overwrite)


class _CollectionWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, stored, batch: int, overwrite: bool):
        self.staged, self.stored, self.batch, self.overwrite = _Staged(folder), stored, batch, overwrite

    def write(self, batches):
        import time
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq

        from lakevec.sources import codec

        system, folder = self.staged.place()
        system.create_dir(folder, recursive=True)
        path, out, n = f"{folder}/_staging_{uuid.uuid4().hex}.parquet", None, 0
        fields = self.stored.fields
        kinds = pa.schema([(f.name, codec.arrow_type(f)) for f in fields])
        first = time.time_ns() >> 20 << 20 | (uuid.uuid4().int & 0xFFF) << 8
        for b in batches:
            columns = []
            for f in fields:
                if f.auto_id:
                    columns.append(pa.array(range(first + n, first + n + b.num_rows), pa.int64()))
                elif f.name not in b.schema.names:
                    columns.append(pa.nulls(b.num_rows, codec.arrow_type(f)))
                else:
                    values = b.column(b.schema.get_field_index(f.name)).cast(codec.arrow_type(f))
                    if f.type.is_vector and f.dim:
                        codec.to_storage(values, f)  # checks the lengths
                    columns.append(values)
            out = out or pq.ParquetWriter(path, kinds, filesystem=system)
            out.write_table(pa.Table.from_arrays(columns, schema=kinds), row_group_size=max(1, self.batch))
            n += b.num_rows
        if out:
            out.close()
        return _Written(path if out else None, n)

    def commit(self, messages):
        old = [x for x in self.staged.visible() if x.rpartition("/")[2].startswith("part-")] if self.overwrite else []
        for m in messages:
            if m and m.path:
                self.staged.publish(m, m.path.rpartition("/")[2].replace("_staging_", "part-"))
        self.staged.remove(old)

    def abort(self, messages):
        self.staged.drop(messages)


def register(spark: SparkSession) -> None:
    for source in (ColumnLog, DeleteLog, LogMeta, LogStats, Collection):
        spark.dataSource.register(source)
