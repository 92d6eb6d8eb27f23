"""Live tables out of column logs and delete logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import deletes
from ..sources import backup, logs, zonemap
from ..types import CollectionSchema

SYSTEM = ("partition_id", "segment_id", "_ordinal", "_ts")


def read_collection(
    spark: SparkSession, base: str, schema: CollectionSchema, collection_id: int, partitions: list[int] | None = None, fields: list[str] | None = None, ignore_ts: bool = False, keep_system: bool = False,
    zones: DataFrame | None = None, keys: DataFrame | None = None,
) -> DataFrame:
    """The live rows below ``base``/insert_log and delta_log, of some ``partitions`` and ``fields`` only if given, and of
    some ``keys`` (a column key of the primary key's type) only if given.

    Partitions and fields that aren't wanted are folders that aren't opened. With ``zones`` (``zonemap.build``, of the
    segments as they are now) neither are segments that can't have one of the keys, and the rows of segments that can't have
    a deleted key go past the deletes.
    """
    key = schema.primary.name
    wanted = None if fields is None else list(dict.fromkeys([*fields, key]))
    part = "*" if partitions is None else "{" + ",".join(map(str, partitions)) + "}"
    ids = "*" if wanted is None else "{" + ",".join(str(i) for i in [1, *(schema.by_name(f).field_id for f in wanted)]) + "}"
    path = f"{base}/insert_log/{collection_id}/{part}/*/{ids}"
    wanted_segments = None
    if zones is not None:
        wanted_segments = zones if keys is None else zones.join(zonemap.segments_with(zones, keys), ["partition_id", "segment_id"], "left_semi")
        wanted_segments = storage.materialise(wanted_segments, "zones")
    read = lambda some: logs.read_segments(spark, path, schema, wanted, segments=some)
    rows = read(wanted_segments)
    kind = schema.primary.spark_type().simpleString()
    if storage.exists(spark, f"{base}/delta_log/{collection_id}"):
        d = logs.read_deletes(spark, f"{base}/delta_log/{collection_id}") if partitions is None else logs.read_deletes(spark, [f"{base}/delta_log/{collection_id}/{p}" for p in (*partitions, -1) if storage.exists(spark, f"{base}/delta_log/{collection_id}/{p}")])
        gone = deletes.consolidate(deletes.keyed(d, "pk", "ts", kind, partition="partition_id"))
        if zones is None:
            rows = deletes.apply(rows, gone, key, "_ts", "partition_id", ignore_ts)
        else:
            touched = storage.materialise(zonemap.segments_with(wanted_segments, gone.select(F.col("_pk").alias("key"))), "touched")
            others = wanted_segments.join(touched, ["partition_id", "segment_id"], "left_anti")
            rows = deletes.apply(read(touched), gone, key, "_ts", "partition_id", ignore_ts).unionByName(read(others))
    if keys is not None:
        rows = rows.join(keys.select(F.col("key").alias(key)).distinct(), key, "left_semi")
    return rows if keep_system else rows.select(*(fields or [f.name for f in schema.fields]))


def read_backup_collection(spark: SparkSession, path: str, collection: str, database: str | None = None, ignore_ts: bool = False, keep_system: bool = False) -> DataFrame:
    """The rows that a collection of a backup had: its segments' columns without what segment, partition and
    collection deletes remove, as one lazily built plan over all segments."""
    tree = backup.read_backup(spark, path)
    schema = backup.collection_schema(tree, collection, database)
    s = backup.segments(tree).where(F.col("collection_name") == collection)
    if database:
        s = s.where(F.coalesce("db_name", F.lit("default")) == database)
    # metadata: a row for each segment
    known = s.select("collection_id", "partition_id", "segment_id", "is_l0", "scope").collect()
    empty = spark.createDataFrame([], schema.to_struct())
    if not any(not r["is_l0"] for r in known):
        return empty
    base, coll = path.rstrip("/"), known[0]["collection_id"]
    live = spark.createDataFrame([(r["partition_id"], r["segment_id"]) for r in known if not r["is_l0"]], "partition_id long, segment_id long")
    rows = logs.read_segments(spark, f"{base}/binlogs/insert_log/{coll}", schema, segments=live)  # of others no file is opened
    folder = f"{base}/binlogs/delta_log/{coll}"
    if storage.exists(spark, folder):
        kind = schema.primary.spark_type().simpleString()
        d = logs.read_deletes(spark, folder)
        rows = deletes.apply(rows, deletes.consolidate(deletes.keyed(d, "pk", "ts", kind, partition="partition_id")), schema.primary.name, "_ts", "partition_id", ignore_ts)
    return rows if keep_system else rows.drop(*SYSTEM)


def backup_deletes(spark: SparkSession, path: str, collection: str, scope: str = "partition") -> DataFrame:
    """(pk, ts, partition_id) of the delete segments of a backup's partitions, or of the whole collection
    (``scope`` "collection"); empty where there are none."""
    s = backup.segments(backup.read_backup(spark, path)).where((F.col("collection_name") == collection) & F.col("is_l0") & (F.col("scope") == scope))
    known = s.select("collection_id", "partition_id", "segment_id").collect()  # metadata: a row for each delete segment
    wanted = {f"{r[0]}/{r[1]}/{r[2]}" for r in known}
    there = [f for c in {r[0] for r in known} for f in storage.glob_folders(spark, f"{path.rstrip('/')}/binlogs/delta_log/{c}/*/*")]
    return logs.read_deletes(spark, [f for f in there if "/".join(f.rsplit("/", 3)[1:]) in wanted]).select("pk", "ts", "partition_id")


def restore(spark: SparkSession, path: str, collection: str, root: str, database: str = "default", partition: str = "") -> int:
    """A backup's collection into the store at ``root``, which is made there if need be; the number of rows."""
    from ..catalog import Catalog

    schema = backup.collection_schema(backup.read_backup(spark, path), collection)
    store = Catalog(spark, root)
    store.ensure(database, schema, partition)
    return store.append(read_backup_collection(spark, path, collection), database, collection, partition)


def backup_to_parquet(spark: SparkSession, path: str, collection: str, out: str, side: DataFrame | None = None, on: str = "id", files: int | None = None) -> None:
    """Restore, enrich by a left join with ``side``, write: by segment, or in ``files`` files."""
    df = read_backup_collection(spark, path, collection, keep_system=files is None)
    if side is not None:
        df = df.join(side, [on], "left")
    if files is None:
        df.drop("_ordinal", "_ts").write.mode("overwrite").partitionBy("partition_id", "segment_id").parquet(out)
    else:
        df.coalesce(files).write.mode("overwrite").parquet(out)
