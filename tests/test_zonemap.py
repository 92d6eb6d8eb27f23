"""Zone maps: filters that never say no wrongly, segments that aren't opened."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevec import storage
from lakevec.plans import collection as plans
from lakevec.sinks import column_log
from lakevec.sources import zonemap
from lakevec.types import CollectionSchema, Field, FieldType

NUMBERS = CollectionSchema("n", (Field("id", FieldType.INT64, 100, primary=True, nullable=False), Field("v", FieldType.DOUBLE, 101)))
TEXTS = CollectionSchema("t", (Field("id", FieldType.VARCHAR, 100, primary=True, nullable=False, max_length=64), Field("v", FieldType.DOUBLE, 101)))


def test_filters():
    r = np.random.default_rng(1)
    mine, others = r.integers(-(2**63), 2**63 - 1, 5000), r.integers(-(2**63), 2**63 - 1, 20_000)
    bloom = zonemap.make_filter(mine)
    assert zonemap.may_have(bloom, mine).all() and zonemap.may_have(bloom, others).mean() < 0.03
    assert not zonemap.may_have(zonemap.make_filter(mine[:0]), mine).any()


@pytest.fixture(params=["numbers", "texts"])
def stored(request, spark, tmp_path):
    """20 segments of 50 keys each: neighbours in even segments, strewn in odd ones."""
    text = request.param == "texts"
    key = F.format_string("key-%06d", F.col("k")) if text else F.col("k")
    k = F.when(F.col("id") % 2 == 0, F.col("id") * 1000 + F.col("j")).otherwise(F.col("j") * 2_000 + 500_000 + F.col("id"))
    rows = spark.range(20).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(49)))).withColumn("k", k)
    rows = rows.select((F.col("id") % 3).alias("partition_id"), F.col("id").alias("segment_id"), F.lit(5).cast("long").alias("_ts"), key.alias("id"), F.col("k").cast("double").alias("v"))
    schema = TEXTS if text else NUMBERS
    column_log.write_files(column_log.encode_segments(rows, schema, 7), str(tmp_path), 7)
    zones = storage.materialise(zonemap.build(spark, f"{tmp_path}/insert_log/7", schema), "zones")
    return tmp_path, rows, schema, zones


def spoil(base, keep):
    """Make all segments but ``keep`` unreadable."""
    n = 0
    for path in glob.glob(f"{base}/insert_log/7/*/*/*/*"):
        if int(path.split(os.sep)[-3]) not in keep:
            open(path, "wb").write(b"no log")
            n += 1
    return n


def test_only_matching_segments_are_opened(spark, stored):
    base, rows, schema, zones = stored
    assert zones.count() == 20 and zones.agg(F.sum("rows")).first()[0] == 1000
    keys = rows.where("v in (2003, 4049, 540003)").select(F.col("id").alias("key"))
    found = {r.segment_id for r in zonemap.segments_with(zones, keys).collect()}
    assert {2, 4, 3} <= found and len(found) <= 5
    want = sorted((r.id, r.v) for r in rows.where("v in (2003, 4049, 540003)").collect())
    assert spoil(base, found) > 0
    got = plans.read_collection(spark, str(base), schema, 7, zones=zones, keys=keys)
    assert sorted((r.id, r.v) for r in got.collect()) == want and len(want) == 3
    nothing = spark.createDataFrame([(None,)], f"key {schema.primary.spark_type().simpleString()}")
    assert plans.read_collection(spark, str(base), schema, 7, zones=zones, keys=nothing).count() == 0


def test_deletes_skip_segments(spark, stored):
    base, rows, schema, zones = stored
    gone = rows.where("v in (6001, 8002, 560003)")
    column_log.write_files(column_log.encode_deletes(gone.select(F.lit(-1).cast("long").alias("partition_id"), F.lit(1).cast("long").alias("segment_id"), F.col("id").alias("pk"), F.lit(9).cast("long").alias("ts")), 7, schema.primary.type), str(base), 7, "delta_log")
    plain = sorted(r.v for r in plans.read_collection(spark, str(base), schema, 7).collect())
    zoned = sorted(r.v for r in plans.read_collection(spark, str(base), schema, 7, zones=zones).collect())
    assert plain == zoned and len(plain) == 997
    touched = {r.segment_id for r in zonemap.segments_with(zones, gone.select(F.col("id").alias("key"))).collect()}
    assert {6, 8, 3} <= touched and len(touched) <= 5


def test_asking_that_does_not_pay(spark, stored, monkeypatch):
    _, rows, _, zones = stored
    monkeypatch.setattr(zonemap, "PAIRS", 0.0001)
    assert zonemap.segments_with(zones, rows.select(F.col("id").alias("key"))).count() == 20
