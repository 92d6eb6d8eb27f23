"""Zone maps of column logs: for each segment the range of its keys, from footers, and a Bloom filter of them.

They are asked before any file is opened: a filter by keys opens only segments that may have one of them, and deletes are
joined only to segments that may have a deleted key. Filters never say no wrongly, so results are the same without them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.interval import interval_join
from ..types import CollectionSchema
from . import logs

#: Bits of a filter for each key, and places that a key sets: about one wrong yes in a hundred.
BITS, PLACES = 10, 7
#: Pairs of a key and a segment whose range holds it, as a multiple of the rows, beyond which asking doesn't pay.
PAIRS, SAMPLE = 4, 1000
ZONES = "partition_id long, segment_id long, rows long, bloom binary"


def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    h = hashes.astype(np.int64).view(np.uint64)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(PLACES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def make_filter(hashes: np.ndarray) -> bytes:
    bits = 1 << max(6, (BITS * len(hashes) - 1).bit_length()) if len(hashes) else 64
    on = np.zeros(bits, bool)
    on[_places(hashes, bits).ravel()] = True
    return np.packbits(on).tobytes()


def may_have(bloom: bytes, hashes: np.ndarray) -> np.ndarray:
    on = np.unpackbits(np.frombuffer(bloom, np.uint8)).astype(bool)
    return on[_places(hashes, len(on))].all(1)


def _ranked(value: Column, kind: str) -> Column:
    """A number that grows with the key: itself, or the first seven bytes of a text."""
    if kind != "string":
        return value.cast("bigint")
    return F.conv(F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 14), 14, F.lit("0")), 16, 10).cast("bigint")


def build(spark: SparkSession, paths: str, schema: CollectionSchema) -> DataFrame:
    """A row for each segment below ``paths`` (.../{partition}/{segment}/{field}/{file}): partition_id, segment_id, rows,
    bloom, least and most. Only the files of the key column are opened; the range is null where footers have none."""
    key = schema.primary
    kind = key.spark_type().simpleString()
    column = f"{paths.rstrip('/')}/*/*/{key.field_id}"

    def filters(names, table):
        partition, segment = (k.as_py() for k in names)
        return pa.table({"partition_id": pa.array([partition], pa.int64()), "segment_id": pa.array([segment], pa.int64()), "rows": pa.array([len(table)], pa.int64()), "bloom": pa.array([make_filter(table.column("hash").to_numpy())], pa.binary())})

    keys = logs.read_segments(spark, column, schema, [key.name], with_system=False)
    blooms = keys.select("partition_id", "segment_id", key_hash(F.col(key.name)).alias("hash")).groupBy("partition_id", "segment_id").applyInArrow(filters, ZONES)
    part = lambda i: F.regexp_extract("path", rf"(\d+)/(\d+)/(?:\2/)?{key.field_id}/([^/]+)$", i).try_cast("long")
    ends = [F.when(F.count("*") == F.count(c), f(F.col(c).try_cast(kind))).alias(n) for c, f, n in (("min", F.min, "least"), ("max", F.max, "most"))]
    ranges = logs.read_stats(spark, column).groupBy(part(1).alias("partition_id"), part(2).alias("segment_id")).agg(*ends)
    return blooms.join(ranges, ["partition_id", "segment_id"], "left")


def _pays(zones: DataFrame, keys: DataFrame, kind: str) -> bool:
    """Whether pairs of keys and segments stay within PAIRS times the rows, by a sample of the keys."""
    n_keys = keys.count()
    rows, segments = zones.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
    if n_keys * segments <= PAIRS * rows:
        return True
    some = keys.select(_ranked(F.col("key"), kind).alias("k")).orderBy(F.xxhash64("key")).limit(SAMPLE)
    inside = zones.select(_ranked(F.col("least"), kind).alias("a"), _ranked(F.col("most"), kind).alias("b"))
    sample = [r["k"] for r in some.collect()]  # SAMPLE numbers
    held = inside.select(F.size(F.filter(F.array(*[F.lit(k) for k in sample]), lambda k: F.coalesce((k >= F.col("a")) & (k <= F.col("b")), F.lit(True)))).alias("n")).agg(F.sum("n")).first()[0]
    return held / max(1, len(sample)) * n_keys <= PAIRS * rows


def segments_with(zones: DataFrame, keys: DataFrame) -> DataFrame:
    """(partition_id, segment_id) of the segments that may have one of ``keys`` (key, in the type of the primary key).

    Keys meet the ranges by an interval join, and what is left the filters, segment by segment. Where ranges overlap so
    much that this is more work than reading (see PAIRS), all segments are returned."""
    kind = keys.schema["key"].dataType.simpleString()
    keys = keys.where("key IS NOT NULL").distinct()
    every = zones.select("partition_id", "segment_id")
    if not _pays(zones, keys, kind):
        return every
    ranked = keys.select(_ranked(F.col("key"), kind).alias("k"), key_hash(F.col("key")).alias("hash"))
    known = zones.where("least IS NOT NULL").select("partition_id", "segment_id", _ranked(F.col("least"), kind).alias("a"), (_ranked(F.col("most"), kind) + 1).alias("b"))
    pairs = interval_join(ranked, known, "k", "a", "b").select("partition_id", "segment_id", "hash")

    def ask(names, mine, filters):
        partition, segment = (k.as_py() for k in names)
        yes = len(mine) and len(filters) and may_have(filters.column("bloom")[0].as_py(), mine.column("hash").to_numpy()).any()
        n = int(bool(yes))
        return pa.table({"partition_id": pa.array([partition] * n, pa.int64()), "segment_id": pa.array([segment] * n, pa.int64())})

    by = ("partition_id", "segment_id")
    filters = zones.select(*[F.col(c).alias(c) for c in (*by, "bloom")])
    found = pairs.groupBy(*by).cogroup(filters.groupBy(*by)).applyInArrow(ask, "partition_id long, segment_id long")
    return found.unionByName(zones.where("least IS NULL").select(*by))
