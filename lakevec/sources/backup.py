"""Backup metadata: a JSON tree of collections, partitions, segments and files, as nested rows and flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..types import CollectionSchema, Field, FieldType

_FILES = "array<struct<fieldID: bigint, binlogs: array<struct<log_path: string, log_size: bigint>>>>"
_SEGMENT = f"struct<segment_id: bigint, collection_id: bigint, partition_id: bigint, num_of_rows: bigint, is_l0: boolean, size: bigint, binlogs: {_FILES}, deltalogs: {_FILES}>"
_FIELD = (
    "struct<fieldID: bigint, name: string, is_primary_key: boolean, data_type: string, autoID: boolean, nullable: boolean, element_type: string, "
    "is_partition_key: boolean, type_params: array<struct<key: string, value: string>>>"
)
#: Types are read as text: they come as numbers or names.
SCHEMA = (
    "id string, state_code string, name string, backup_timestamp bigint, size bigint, collection_backups array<struct<collection_id: bigint, db_name: string, "
    f"collection_name: string, schema: struct<name: string, fields: array<{_FIELD}>>, shards_num: int, backup_timestamp: bigint, "
    "index_infos: array<struct<field_name: string, index_name: string, index_type: string, params: map<string,string>>>, "
    f"partition_backups: array<struct<partition_id: bigint, partition_name: string, collection_id: bigint, segment_backups: array<{_SEGMENT}>>>, l0_segments: array<{_SEGMENT}>>>"
)
# fixed values: other names of the type codes
_NAMES = {
    "Bool": 1, "Int8": 2, "Int16": 3, "Int32": 4, "Int64": 5, "Float": 10, "Double": 11, "String": 20, "VarChar": 21, "Array": 22, "Json": 23, "JSON": 23,
    "BinaryVector": 100, "FloatVector": 101, "Float16Vector": 102, "BFloat16Vector": 103, "SparseFloatVector": 104,
}


def read_backup(spark: SparkSession, path: str) -> DataFrame:
    """One row: the tree in ``path``/meta/full_meta.json. Unknown fields are passed over; left out ones are null."""
    return spark.read.schema(SCHEMA).option("multiLine", "true").json(f"{path.rstrip('/')}/meta/full_meta.json")


def read_flat(spark: SparkSession, path: str, level: str) -> DataFrame:
    """The rows (``infos``) of collection_meta, partition_meta, segment_meta or backup_meta."""
    raw = spark.read.option("multiLine", "true").json(f"{path.rstrip('/')}/meta/{level}_meta.json")
    return raw.select(F.explode("infos").alias("info")).select("info.*") if "infos" in raw.columns else raw


def collections(backup: DataFrame) -> DataFrame:
    return backup.select(F.explode("collection_backups").alias("c")).select("c.*")


def segments(backup: DataFrame) -> DataFrame:
    """One row per segment: db, collection, partition and segment ids, rows, is_l0, scope (partition or collection).

    Collection-wide delete segments have partition_id -1.
    """
    c = collections(backup)
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name.split(".")[-1])
    ids = ["db_name", "collection_name", F.col("collection_id").alias("in_collection")]
    inside = c.select(*ids, F.explode("partition_backups").alias("p")).select("db_name", "collection_name", "in_collection", F.col("p.partition_id").alias("in_partition"), F.col("p.partition_name").alias("partition_name"), F.explode("p.segment_backups").alias("s"))
    wide = c.select(*ids, F.lit(-1).cast("long").alias("in_partition"), F.lit(None).cast("string").alias("partition_name"), F.explode("l0_segments").alias("s"))
    both = inside.withColumn("scope", F.lit("partition")).unionByName(wide.withColumn("scope", F.lit("collection")))
    return both.select(
        "db_name", "collection_name", F.col("in_collection").alias("collection_id"), F.col("in_partition").alias("partition_id"), "partition_name",
        F.col("s.segment_id").alias("segment_id"), zero("s.num_of_rows"), (F.coalesce("s.is_l0", F.lit(False)) | (F.col("scope") == "collection")).alias("is_l0"), "scope",
        F.col("s.binlogs").alias("binlogs"), F.col("s.deltalogs").alias("deltalogs"),
    )


def log_files(segments: DataFrame, kind: str = "binlogs") -> DataFrame:
    """One row per file of ``binlogs`` or ``deltalogs``: ids, field_id, log_path, log_size."""
    f = segments.select("collection_id", "partition_id", "segment_id", F.explode(kind).alias("f"))
    f = f.select("collection_id", "partition_id", "segment_id", F.coalesce("f.fieldID", F.lit(0)).alias("field_id"), F.explode("f.binlogs").alias("b"))
    return f.select("collection_id", "partition_id", "segment_id", "field_id", F.col("b.log_path").alias("log_path"), F.col("b.log_size").alias("log_size"))


def _type(code: str | None) -> FieldType | None:
    return None if not code or code in ("0", "None") else FieldType(int(code)) if code.isdigit() else FieldType(_NAMES[code])


def collection_schema(backup: DataFrame, collection: str, database: str | None = None) -> CollectionSchema:
    """The schema of one collection (metadata: one row); ValueError if the backup has none of that name."""
    found = collections(backup).where(F.col("collection_name") == collection)
    if database:
        found = found.where(F.coalesce("db_name", F.lit("default")) == database)
    row = found.select("schema").first()
    if row is None:
        raise ValueError(f"the backup has no collection {collection}")
    fields = []
    for f in row["schema"]["fields"]:
        params = {p["key"]: p["value"] for p in f["type_params"] or []}
        fields.append(
            Field(f["name"], _type(f["data_type"]), f["fieldID"] or 0, int(params.get("dim", 0)), int(params.get("max_length", 0)), _type(f["element_type"]), bool(f["is_primary_key"]), bool(f["autoID"]), bool(f["nullable"]))
        )
    return CollectionSchema(collection, tuple(f for f in fields if f.field_id >= 100))
