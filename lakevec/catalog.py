"""A collection store on a file system: databases, collections, partitions; append, search, indexes, imports.

A collection is a folder of Parquet files under ``{root}/{database}/{collection}/data/_partition=...`` with its schema
beside it. Appends go through Spark's committer: a failed job publishes nothing. The service's other calls (flush,
load, index, import jobs) are entries of the same metadata.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import storage
from .functions import vectors
from .operators import ivf, topk
from .options import Options
from .types import CollectionSchema, FieldType

DEFAULT_PARTITION = "_default"
INDEX_TYPES = ("AUTOINDEX", "FLAT", "IVF_FLAT", "HNSW", "Trie")
#: States of an import job.
PENDING, FAILED, DONE = "pending", "failed", "done"


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # metadata: small text files, written and read by Hadoop's file system

    def _path(self, database: str, collection: str = "", *more: str) -> str:
        return "/".join([self.root, database or "default", *[x for x in (collection, *more) if x]])

    def _write(self, path: str, text: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _read(self, path: str) -> str:
        return "\n".join(r[0] for r in self.spark.read.text(path).collect())

    def ensure(self, database: str, schema: CollectionSchema, partition: str = "") -> None:
        """Make the database, collection and partition that aren't there yet. ValueError if the collection is there with
        other fields."""
        path = self._path(database, schema.name, "schema.json")
        if storage.exists(self.spark, path):
            have = self.describe(database, schema.name)
            if [(f.name, f.type) for f in have.fields] != [(f.name, f.type) for f in schema.fields]:
                raise ValueError(f"collection {schema.name} has other fields")
        else:
            self._write(path, schema.dumps())
        if partition:
            self._write(self._path(database, schema.name, "partitions", partition), "{}")

    def has(self, database: str, collection: str) -> bool:
        return storage.exists(self.spark, self._path(database, collection, "schema.json"))

    def describe(self, database: str, collection: str) -> CollectionSchema:
        return CollectionSchema.loads(self._read(self._path(database, collection, "schema.json")))

    def drop(self, database: str, collection: str) -> None:
        storage.delete(self.spark, self._path(database, collection))

    def create_index(self, database: str, collection: str, field: str, metric: str = "L2", kind: str = "AUTOINDEX", cells: int | None = None) -> None:
        """Metadata that ``search`` takes its metric from and, for IVF_FLAT, an inverted-file index of the rows so far.

        The index holds a copy of the rows by cell, and the names of the data files that it was made of: rows that are
        appended later are searched exactly beside it, until it is made anew. IVF_FLAT needs a vector of floats."""
        f = self.describe(database, collection).by_name(field)
        if kind not in INDEX_TYPES:
            raise ValueError(f"unknown index type {kind}")
        entry = {"field": field, "metric": metric.upper(), "type": kind}
        if kind == "IVF_FLAT":
            if metric.upper() not in ivf.METRICS or f.type not in (FieldType.FLOAT_VECTOR, FieldType.FLOAT16_VECTOR, FieldType.BFLOAT16_VECTOR):
                raise ValueError(f"no {kind} index of {field} by {metric}")
            entry |= self._build(database, collection, field, metric.upper(), cells)
        self._write(self._path(database, collection, "indexes", field), json.dumps(entry))

    def _files(self, database: str, collection: str) -> DataFrame:
        """(file) of a collection's data, which are listed, not read."""
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self._path(database, collection, "data")).select(F.col("path").alias("file"))

    def _build(self, database: str, collection: str, field: str, metric: str, cells: int | None) -> dict:
        schema = self.describe(database, collection)
        base = self._path(database, collection, "index_data", field, uuid.uuid4().hex)
        key = schema.primary.name
        path = self._path(database, collection, "data")
        files = [r[0] for r in self._files(database, collection).collect()] if storage.exists(self.spark, path) else []  # a name for each file
        # the very files that are written down, whatever is appended meanwhile
        rows = self.spark.read.option("basePath", path).parquet(*files) if files else self.read(database, collection).withColumn("_partition", F.lit(""))
        first = rows.select(F.size(field).alias("n")).where("n > 0").first()
        dim = schema.by_name(field).dim or (first["n"] if first else 1)
        found = ivf.write(rows, field, ivf.train(rows, field, key, dim, metric, cells), f"{base}/rows")
        ivf.save_cells(self.spark, found, f"{base}/cells")
        self.spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{base}/files")
        probes = ivf.calibrate(self.spark.read.parquet(f"{base}/rows"), found, key, field) if len(found.centres) else 0
        return {"base": base, "cells": len(found.centres), "probes": probes, **ivf.described(found)}

    def index(self, database: str, collection: str, field: str) -> dict | None:
        path = self._path(database, collection, "indexes", field)
        return json.loads(self._read(path)) if storage.exists(self.spark, path) else None

    def drop_index(self, database: str, collection: str, field: str) -> None:
        for path in (self._path(database, collection, "indexes", field), self._path(database, collection, "index_data", field)):
            if storage.exists(self.spark, path):
                storage.delete(self.spark, path)

    def _indexed(self, database: str, collection: str, entry: dict) -> tuple[DataFrame, DataFrame] | None:
        """(rows by cell, rows that came later), or None where files that the index was made of are gone: it is stale then."""
        known, now = self.spark.read.parquet(f"{entry['base']}/files"), self._files(database, collection)
        if known.join(now, "file", "left_anti").limit(1).count():
            return None
        path = self._path(database, collection, "data")
        late = [r[0] for r in now.join(known, "file", "left_anti").collect()]  # names of files since the index
        stored = self.spark.read.parquet(f"{entry['base']}/rows")
        rest = self.spark.read.option("basePath", path).parquet(*late) if late else stored.drop("_cell", "_from_centre").limit(0)
        return stored, rest

    def flush(self, database: str, collection: str) -> int:
        """The rows that are visible; appends are as soon as they return."""
        return self.read(database, collection).count()

    # rows

    def append(self, df: DataFrame, database: str, collection: str, partition: str = "") -> int:
        """Append by column name: types are checked and narrowed, a key that is given by the store is made here. The
        number of rows, counted while they are written."""
        from pyspark.sql import Observation

        schema = self.describe(database, collection)
        out = []
        for f in schema.fields:
            if f.auto_id:
                continue
            if f.name not in df.columns:
                if not f.nullable:
                    raise ValueError(f"no column is named {f.name}")
                out.append(F.lit(None).cast(f.spark_type()).alias(f.name))
                continue
            out.append(_fitted(df, f).alias(f.name))
        seen = Observation()
        rows = df.select(*out).withColumn("_partition", F.lit(partition or DEFAULT_PARTITION))
        if schema.primary.auto_id:
            stamp = time.time_ns() >> 20 << 20
            rows = rows.withColumn(schema.primary.name, F.lit(stamp) + F.monotonically_increasing_id())
        rows = rows.observe(seen, F.count("*").alias("n"))
        rows.write.mode("append").partitionBy("_partition").parquet(self._path(database, collection, "data"))
        return seen.get["n"]

    def read(self, database: str, collection: str, partition: str = "") -> DataFrame:
        schema = self.describe(database, collection)
        path = self._path(database, collection, "data")
        if not storage.exists(self.spark, path):
            return self.spark.createDataFrame([], schema.to_struct())
        df = self.spark.read.parquet(path)
        df = df.where(F.col("_partition") == partition) if partition else df
        return df.select(*[F.col(f.name).alias(f.name, metadata=f.struct_field().metadata) for f in schema.fields])

    def search(
        self, database: str, collection: str, field: str, query: list[float] | dict[int, float], k: int = 10, output: list[str] | None = None, metric: str = "", where: Column | None = None, partition: str = "",
        probes: int | None = None, exact: bool = False,
    ) -> DataFrame:
        """The ``k`` nearest rows. With an IVF_FLAT index of the metric only its ``probes`` nearest cells are opened (as
        many as its recall was measured with, unless given), and with ``exact`` those that may hold a nearer row; otherwise all rows are scored."""
        schema = self.describe(database, collection)
        entry = self.index(database, collection, field) or {}
        kind = (metric or entry.get("metric") or "L2").upper()
        if entry.get("type") == "IVF_FLAT" and kind == entry["metric"] and entry["cells"]:
            found = self._indexed(database, collection, entry)
            if found:
                cells = ivf.load_cells(self.spark, f"{entry['base']}/cells", kind, entry["dim"], entry["longest"])
                test = F.lit(True) if where is None else where
                test = test & (F.col("_partition") == partition) if partition else test
                return ivf.search(found[0], cells, query, k, schema.primary.name, field, probes or entry["probes"], test, output, exact, found[1])
        rows = self.read(database, collection, partition)
        if schema.by_name(field).type == FieldType.SPARSE_FLOAT_VECTOR:
            return topk.sparse_top_k(rows if where is None else rows.where(where), query, k, schema.primary.name, field)
        return topk.top_k(rows, query, k, kind, schema.primary.name, field, where, output)

    def search_batch(self, database: str, collection: str, field: str, queries: DataFrame, k: int = 10, metric: str = "", probes: int | None = None) -> DataFrame:
        """query_id, rank, id, score of the ``k`` nearest rows of every query (named as the collection's key and vector)."""
        schema, entry = self.describe(database, collection), self.index(database, collection, field) or {}
        kind, key = (metric or entry.get("metric") or "L2").upper(), schema.primary.name
        found = self._indexed(database, collection, entry) if entry.get("type") == "IVF_FLAT" and kind == entry["metric"] and entry["cells"] else None
        if not found:
            return topk.batch_top_k(self.read(database, collection), queries, k, kind, key, field)
        cells = ivf.load_cells(self.spark, f"{entry['base']}/cells", kind, entry["dim"], entry["longest"])
        here = ivf.search_batch(found[0], cells, queries, k, key, field, probes or entry["probes"])
        both = here.unionByName(topk.batch_top_k(found[1], queries, k, kind, key, field))
        order = Window.partitionBy("query_id").orderBy(F.desc("score") if kind != "L2" else F.asc("score"), "id")
        return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # imports

    def bulk_import(self, database: str, collection: str, path: str, kind: str = "parquet", report: Callable[[dict], None] | None = None) -> DataFrame:
        """One job for each file below ``path`` that ends in ``kind``: (job_id, file, state, rows, error)."""
        jobs = []
        for i, file in enumerate(storage.list_files(self.spark, path, f".{kind}")):
            job = {"job_id": i, "file": file, "state": PENDING, "rows": 0, "error": None}
            try:
                if kind == "json":
                    from .sources.rows_json import read_rows

                    df = read_rows(self.spark, file)
                else:
                    df = self.spark.read.format(kind).load(file)
                job |= {"rows": self.append(df, database, collection), "state": DONE}
            except Exception as e:  # noqa: BLE001  one file's failure is its job's result
                job |= {"state": FAILED, "error": str(e)[:500]}
            jobs.append(job)
            if report:
                report(job)
        return self.spark.createDataFrame(jobs, "job_id int, file string, state string, rows long, error string")


def _fitted(df: DataFrame, f) -> Column:
    """A column in the field's type; ANSI casts fail on values that don't fit."""
    have, c = df.schema[f.name].dataType.simpleString(), F.col(f"`{f.name}`")
    if f.type == FieldType.SPARSE_FLOAT_VECTOR:
        return vectors.sparse_from_json(c) if have == "string" else c.cast("map<bigint,float>")
    if f.type == FieldType.BINARY_VECTOR:
        return vectors.packed_bits(c, f.dim) if have == "string" else c
    if f.type in (FieldType.FLOAT_VECTOR, FieldType.FLOAT16_VECTOR, FieldType.BFLOAT16_VECTOR):
        if f.type == FieldType.BFLOAT16_VECTOR and have == "string":
            return vectors.floats_from_bfloat(F.unbase64(c))
        if not have.startswith("array"):
            raise ValueError(f"{f.name} must be an array of floats")
        ok = F.size(c) == f.dim
        return F.when(c.isNull() | ok, c.cast("array<float>")).otherwise(F.raise_error(F.lit(f"{f.name} must have {f.dim} components")).cast("array<float>")) if f.dim else c.cast("array<float>")
    if f.type == FieldType.JSON:
        return F.when(c.isNull() | F.try_parse_json(c).isNotNull(), c).otherwise(F.raise_error(F.lit(f"{f.name} must be JSON")).cast("string"))
    return c.cast(f.spark_type())


def write_collection(df: DataFrame, root: str, given: dict[str, object]) -> int:
    """``df`` into the collection that ``given`` options name, which is made if it isn't there. The number of rows."""
    o = Options(given)
    catalog = Catalog(df.sparkSession, root)
    database, name = o.database, o["collection.name"]
    if not name:
        raise ValueError("collection.name is missing")
    if not catalog.has(database, name):
        schema = CollectionSchema.from_struct(name, df.schema, o["collection.primaryKeyField"], o["collection.vectorField"], o.number("collection.vectorDim"), o.flag("collection.autoID"))
        catalog.ensure(database, schema, o["partition.name"])
    return catalog.append(df, database, name, o["partition.name"])
