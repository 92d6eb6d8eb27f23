"""``format("ledger")``: a table of Parquet files with a log of transactions; batch and streaming sink, snapshots.

Tasks write files under names of their own; a table's files are those that its log names. A commit is one log entry,
``_log/{version}.json``, which exactly one writer can create, so it is there as a whole or not at all. Who comes second reads
the log again and tries the next version: appends follow each other, an overwrite replaces what is there by then. Each entry
says which epoch every streaming writer has reached, so an epoch that is replayed adds nothing. A writer that dies leaves
files that no entry names; ``vacuum`` removes them.

Entries need a file system that creates a file only if it isn't there (local and shared POSIX folders, HDFS).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .datasource import SPLIT_BYTES, _Range, _TableReader

#: So many entries after which one names all files, and how often a commit is tried.
FULL_EVERY, TRIES = 20, 50


class Conflict(Exception):
    """Others committed first, again and again."""


class Log:
    """The transactions of the table at ``path``."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _place(self):
        from lakevec.storage import worker_fs

        return worker_fs(self.path)

    def versions(self) -> list[int]:
        from pyarrow import fs

        system, inner = self._place()
        found = system.get_file_info(fs.FileSelector(f"{inner}/_log", allow_not_found=True))
        return sorted(int(i.base_name[:-5]) for i in found if i.base_name[:-5].isdigit() and i.base_name.endswith(".json"))

    def entry(self, version: int) -> dict:
        system, inner = self._place()
        with system.open_input_stream(f"{inner}/_log/{version:020d}.json") as f:
            return json.loads(f.read())

    def snapshot(self, version: int | None = None) -> dict:
        """version, files ((name, bytes, rows)), schema and epochs as of a version, the latest unless given."""
        known = [v for v in self.versions() if version is None or v <= version]
        if version is not None and version not in known:
            raise ValueError(f"there is no version {version}")
        if not known:
            return {"version": 0, "files": {}, "schema": None, "epochs": {}}
        entries = []
        for v in reversed(known):  # back to the last one that names all files
            entries.append(self.entry(v))
            if entries[-1]["all"] is not None:
                break
        files: dict[str, list] = {}
        for e in reversed(entries):
            if e["all"] is not None:
                files = {name: rest for name, *rest in e["all"]}
                continue
            for name in e["remove"]:
                files.pop(name, None)
            files |= {name: rest for name, *rest in e["add"]}
        return {"version": known[-1], "files": files, "schema": entries[0]["schema"], "epochs": entries[0]["epochs"]}

    def _create(self, version: int, text: bytes) -> bool:
        """Whether this call made the entry; False if it was there."""
        import os

        from lakevec.storage import scheme_of

        system, inner = self._place()
        system.create_dir(f"{inner}/_log", recursive=True)
        target, hidden = f"{inner}/_log/{version:020d}.json", f"{inner}/_log/_{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as out:
            out.write(text)
        try:
            if scheme_of(self.path) == "file":
                try:
                    os.link(hidden, target)
                except FileExistsError:
                    return False
                return True
            if scheme_of(self.path) in ("hdfs", "viewfs"):
                from pyarrow import fs

                try:
                    system.move(hidden, target)  # fails where the target is there
                except OSError:
                    if system.get_file_info(target).type == fs.FileType.NotFound:
                        raise
                    return False
                return True
            raise ValueError(f"{scheme_of(self.path)} paths have no way to create a file only if it isn't there")
        finally:
            from contextlib import suppress

            with suppress(OSError):
                system.delete_file(hidden)

    def commit(self, add: list[tuple[str, int, int]], schema: str, overwrite: bool = False, writer: str = "", epoch: int | None = None) -> int | None:
        """The version that this commit became; None for an epoch that the writer has committed before."""
        for attempt in range(TRIES):
            now = self.snapshot()
            if epoch is not None and now["epochs"].get(writer, -1) >= epoch:
                return None
            if now["schema"] and json.loads(now["schema"])["fields"] != json.loads(schema)["fields"] and not overwrite:
                raise ValueError("the table has other columns")
            version = now["version"] + 1
            files = {} if overwrite else dict(now["files"])
            files |= {name: rest for name, *rest in add}
            whole = overwrite or version % FULL_EVERY == 0 or version == 1
            epochs = now["epochs"] | ({writer: epoch} if epoch is not None else {})
            entry = {"add": add, "remove": sorted(now["files"]) if overwrite else [], "all": [[n, *r] for n, r in files.items()] if whole else None, "schema": schema, "epochs": epochs, "at": time.time()}
            if self._create(version, json.dumps(entry).encode()):
                return version
            time.sleep(min(0.5, 0.01 * 2**attempt))
        raise Conflict(f"{TRIES} commits to {self.path} came too late")

    def vacuum(self, older_than: float = 7 * 86400.0) -> int:
        """Remove data files of that age in seconds that no entry still in the log names; how many."""
        from pyarrow import fs

        named = set()
        for v in self.versions():
            e = self.entry(v)
            named |= {name for name, *_ in (e["all"] or []) + e["add"]}
        system, inner = self._place()
        gone = [i for i in system.get_file_info(fs.FileSelector(f"{inner}/data", allow_not_found=True)) if i.base_name not in named and time.time() - i.mtime.timestamp() >= older_than]
        for i in gone:
            system.delete_file(i.path)
        return len(gone)


class _Files(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


def _written(path: str, batches, schema: StructType) -> _Files:
    """A task's rows as one file."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    from lakevec.storage import worker_fs

    system, inner = worker_fs(path)
    name, out, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
    kinds = to_arrow_schema(schema)
    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            system.create_dir(f"{inner}/data", recursive=True)
            out = pq.ParquetWriter(f"{inner}/data/{name}", kinds, filesystem=system)
        out.write_table(pa.Table.from_batches([batch]).cast(kinds))
        rows += batch.num_rows
    if out is None:
        return _Files([])
    out.close()
    return _Files([(name, system.get_file_info(f"{inner}/data/{name}").size, rows)])


def _removed(path: str, messages) -> None:
    from contextlib import suppress

    from lakevec.storage import worker_fs

    system, inner = worker_fs(path)
    for name, *_ in (f for m in messages if m for f in m.files):
        with suppress(OSError):
            system.delete_file(f"{inner}/data/{name}")


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite

    def write(self, iterator):
        return _written(self.path, iterator, self.schema)

    def commit(self, messages):
        Log(self.path).commit([f for m in messages if m for f in m.files], self.schema.json(), self.overwrite)

    def abort(self, messages):
        _removed(self.path, messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, schema: StructType, writer: str):
        self.path, self.schema, self.writer = path, schema, writer

    def write(self, iterator):
        return _written(self.path, iterator, self.schema)

    def commit(self, messages, batchId):
        added = Log(self.path).commit([f for m in messages if m for f in m.files], self.schema.json(), False, self.writer, batchId)
        if added is None:
            _removed(self.path, messages)  # a replay: its files are in the table already, under other names

    def abort(self, messages, batchId):
        _removed(self.path, messages)


class _Snapshot(_TableReader):
    def __init__(self, path: str, names: list[str], files: dict):
        super().__init__(path, names)
        self.files = files

    def partitions(self):
        from lakevec.storage import worker_fs

        inner = worker_fs(self.path)[1].rstrip("/")
        found = [_Range(f"{inner}/data/{name}", i, i + SPLIT_BYTES) for name, (size, _) in self.files.items() for i in range(0, max(size, 1), SPLIT_BYTES)]
        return found or [_Range("", 0, 0)]

    def read(self, partition):
        return super().read(partition) if partition.path else iter(())


class Ledger(DataSource):
    """Options: path; version (of a read); writer (a streaming writer's name, which its epochs are counted by)."""

    @classmethod
    def name(cls) -> str:
        return "ledger"

    def _version(self) -> int | None:
        return int(self.options["version"]) if "version" in self.options else None

    def schema(self) -> StructType:
        found = Log(self.options["path"]).snapshot(self._version())["schema"]
        if found is None:
            raise ValueError(f"there is no table at {self.options['path']}")
        return StructType.fromJson(json.loads(found))

    def reader(self, schema):
        return _Snapshot(self.options["path"], schema.fieldNames(), Log(self.options["path"]).snapshot(self._version())["files"])

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], schema, overwrite)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options["path"], schema, self.options.get("writer", "stream"))


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version through Spark's own Parquet reader, which takes filters and columns down to the files."""
    found = Log(path).snapshot(version)
    if found["schema"] is None:
        raise ValueError(f"there is no table at {path}")
    schema = StructType.fromJson(json.loads(found["schema"]))
    files = [f"{path.rstrip('/')}/data/{name}" for name in found["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Ledger)
