"""Paths: schemes, listings and globs by Hadoop's file systems, scratch tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(.*)", re.DOTALL)


def parts_of(path: str) -> tuple[str, str, str]:
    """(scheme, bucket or host, path in it). Nothing of the path is taken for a query or a fragment or decoded, as Hadoop
    has it too: ``#``, ``?``, ``%`` and spaces are characters of names."""
    found = _SCHEME.fullmatch(path)
    return (found[1], found[2] or "", found[3]) if found else ("file", "", path)


def scheme_of(path: str) -> str:
    """The scheme of a path, "file" if it has none."""
    return parts_of(path)[0]


def without_bucket(uri: str) -> str:
    """The path inside the bucket."""
    return parts_of(uri)[2].lstrip("/")


def for_import(uri: str) -> str:
    """Import services take s3 where Spark has s3a."""
    return re.sub(r"^s3a://", "s3://", uri)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Files directly in ``path``, without hidden ones (a dot or underscore first), by name."""
    fs, p = _fs(spark, path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isFile()]
    return sorted(x.toString() for x in found if x.getName()[:1] not in "._" and x.getName().endswith(suffix))


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match ``pattern``; FileNotFoundError if there are none."""
    fs, p = _fs(spark, pattern)
    found = sorted(s.getPath().toString() for s in fs.globStatus(p) or [] if s.isFile() and s.getPath().getName()[:1] not in "._")
    if not found:
        raise FileNotFoundError(pattern)
    return found


def glob_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match ``pattern``, by one listing."""
    fs, p = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [] if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


WORKER_SCHEMES = ("file", "s3", "s3a", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")


def worker_can_open(path: str) -> bool:
    """Whether pyarrow's file systems, which is what a Python worker has, know the path's scheme."""
    return scheme_of(path) in WORKER_SCHEMES


def worker_fs(path: str):
    """(pyarrow file system, path in it), for use in tasks. ValueError for a scheme that only Spark can open."""
    from pyarrow import fs

    if not worker_can_open(path):
        raise ValueError(f"a Python worker can't open {scheme_of(path)} paths: {path}")
    scheme, place, inner = parts_of(path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + inner.lstrip("/") if path.startswith("file:") else path
    system, root = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 'gcs': 'gs'}.get(scheme, scheme)}://{place}/")
    return system, root.rstrip("/") + "/" + inner.lstrip("/")


def put(path: str, content: bytes) -> None:
    """Write a file under a hidden name and move it to its own, on the path's own file system: a lost or repeated task
    leaves no half file."""
    system, inner = worker_fs(path)
    folder, _, name = inner.rpartition("/")
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/_staging_{uuid.uuid4().hex}_{name}"
    with system.open_output_stream(hidden) as out:
        out.write(content)
    system.move(hidden, inner)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder. Without ``spark.checkpoint.dir`` a local session takes a temporary
    folder of its machine; any other one raises, as executors share no disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    root = root or getattr(scratch, "local", None)
    if not root:
        root = scratch.local = tempfile.mkdtemp(prefix="lakevec-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/lakevec-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
