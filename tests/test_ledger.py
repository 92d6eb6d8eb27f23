"""Transactions: snapshots, replayed epochs, writers that race or die; keyed state and its expiry."""

import threading

import pytest
from pyspark.sql import functions as F

from lakevec.sources import ledger
from lakevec.sources.ledger import Log
from lakevec.streaming import settle
from lakevec.streaming.keyed import live_changes, settled


def put(spark, df, path, mode="append"):
    ledger.register(spark)
    df.write.format("ledger").option("path", path).mode(mode).save()


def ids(df):
    return sorted(r.id for r in df.collect())


def test_snapshots_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "t#1")
    put(spark, spark.range(5).repartition(2), path)
    put(spark, spark.range(5, 8), path)
    put(spark, spark.range(2), path, "overwrite")
    read = lambda **o: ids(spark.read.format("ledger").options(**o).load(path))
    assert read() == [0, 1] == ids(ledger.read_snapshot(spark, path))
    assert read(version=1) == list(range(5)) and read(version=2) == list(range(8)) == ids(ledger.read_snapshot(spark, path, 2))
    with pytest.raises(ValueError, match="no version"):
        Log(path).snapshot(9)
    with pytest.raises(Exception, match="other columns"):
        put(spark, spark.range(3).withColumnRenamed("id", "x"), path)
    assert read() == [0, 1]
    with pytest.raises(ValueError, match="no table"):
        ledger.read_snapshot(spark, str(tmp_path / "none"))


def test_failed_and_dead_writers_show_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, spark.range(4), path)
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        put(spark, bad, path)
    assert ids(ledger.read_snapshot(spark, path)) == list(range(4))
    import pyarrow as pa

    ledger._written(path, [pa.record_batch({"id": pa.array([9, 9])})], spark.range(1).schema)  # wrote its file, then died
    assert ids(ledger.read_snapshot(spark, path)) == list(range(4)) and Log(path).versions() == [1]
    assert Log(path).vacuum(3600) == 0 and Log(path).vacuum(0) >= 1
    assert ids(ledger.read_snapshot(spark, path)) == list(range(4))


def test_writers_that_race(tmp_path):
    log, schema = Log(str(tmp_path / "t")), '{"type": "struct", "fields": []}'
    done = []

    def write(w):
        for i in range(8):
            done.append(log.commit([(f"{w}-{i}", 1, 1)], schema, writer=f"w{w}", epoch=i))

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done) == list(range(1, 33)) == log.versions()
    now = log.snapshot()
    assert set(now["files"]) == {f"{w}-{i}" for w in range(4) for i in range(8)} and now["epochs"] == {f"w{w}": 7 for w in range(4)}
    assert log.commit([("again", 1, 1)], schema, writer="w2", epoch=7) is None and log.commit([("again", 1, 1)], schema, writer="w2", epoch=3) is None
    assert set(log.snapshot(5)["files"]) < set(now["files"]) and log.snapshot()["version"] == 32


def test_a_replayed_stream_adds_nothing(spark, tmp_path):
    ledger.register(spark)
    base = str(tmp_path)
    spark.range(10).write.parquet(f"{base}/in")
    rows = spark.readStream.schema("id long").parquet(f"{base}/in")

    def run(state):
        rows.writeStream.format("ledger").option("path", f"{base}/t").option("checkpointLocation", f"{base}/{state}").trigger(availableNow=True).start().awaitTermination()

    run("one")
    run("one")
    run("lost")  # the checkpoint is gone: the same epoch with the same rows comes again
    assert ids(ledger.read_snapshot(spark, f"{base}/t")) == list(range(10))
    spark.range(10, 12).write.mode("append").parquet(f"{base}/in")
    run("one")
    assert ids(ledger.read_snapshot(spark, f"{base}/t")) == list(range(12))


def test_live_keys_in_any_order(spark, tmp_path):
    base = str(tmp_path)
    schema = "k string, t long, gone boolean, v string"
    spark.createDataFrame([], schema).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(schema).parquet(f"{base}/in")
    changes = live_changes(spark, stream, "k", "t", "gone", "v")

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
        settle(changes, f"{base}/out", f"{base}/state")
        return {r.pk: (r.ts, r.value) for r in settled(spark.read.parquet(f"{base}/out")).collect()}

    assert arrive(("a", 5, False, "x"), ("b", 9, True, None), (None, 1, False, "n"), ("c", None, False, "n")) == {"a": (5, "x")}
    assert arrive(("b", 9, False, "late"), ("a", 3, False, "older"), ("d", 1, False, None)) == {"a": (5, "x"), "d": (1, None)}
    assert arrive(("a", 5, True, None), ("b", 10, False, "new")) == {"b": (10, "new"), "d": (1, None)}
    assert arrive(("a", 6, False, "back")) == {"a": (6, "back"), "b": (10, "new"), "d": (1, None)}


def test_forgotten_deletes(spark, tmp_path):
    """Event-time timers: once the watermark has passed a delete, its key's state goes; rows behind the watermark are dropped."""
    base, second = str(tmp_path), 1_000_000
    schema = "k string, t long, gone boolean, v string"
    spark.createDataFrame([], schema).write.parquet(f"{base}/in")
    changes = live_changes(spark, spark.readStream.schema(schema).parquet(f"{base}/in"), "k", "t", "gone", "v", late="10 seconds")

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
        settle(changes, f"{base}/out", f"{base}/state")
        kept = spark.read.format("statestore").option("stateVarName", "live").load(f"{base}/state").select("key.pk").collect()
        return {r.pk for r in kept}, {r.pk: r.value for r in settled(spark.read.parquet(f"{base}/out")).collect()}

    assert arrive(("a", 9 * second, True, None), ("b", 9 * second, False, "x"))[0] == {"a", "b"}
    assert arrive(("c", 100 * second, False, "y")) == ({"b", "c"}, {"b": "x", "c": "y"})
    assert arrive(("a", 5 * second, False, "too late"), ("a", 95 * second, False, "new")) == ({"a", "b", "c"}, {"a": "new", "b": "x", "c": "y"})
