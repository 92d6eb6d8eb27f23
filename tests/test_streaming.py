from pyspark.sql import functions as F

from lakevec.sinks import column_log
from lakevec.streaming import latest_deletes, sessions, stream_deletes, tumbling


def test_deletes_as_they_arrive(spark, tmp_path):
    for segment, rows in ((1, [("1", 10), ("2", 20)]), (2, [("1", 30)])):
        d = spark.createDataFrame([(1, segment, k, t) for k, t in rows], "partition_id long, segment_id long, pk string, ts long")
        column_log.write_files(column_log.encode_deletes(d, 7), str(tmp_path), 7, "delta_log")
    stream = stream_deletes(spark, f"{tmp_path}/delta_log/7/*/*", 1)
    q = latest_deletes(stream).writeStream.format("memory").queryName("latest").outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.pk, r.ts) for r in spark.table("latest").collect()) == [("1", 30), ("2", 20)]


def test_windows_with_late_rows(spark, tmp_path):
    src = f"{tmp_path}/src"
    schema = "k string, at timestamp"
    rows = [("a", "2024-01-01 00:00:10"), ("a", "2024-01-01 00:00:50"), ("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 00:00:30")]
    spark.createDataFrame(rows, "k string, at string").select("k", F.to_timestamp("at").alias("at")).write.parquet(src)
    batch = tumbling(spark.read.parquet(src), "at", "1 minute", ["k"])
    assert sorted((r.k, r.window_start.minute, r.n) for r in batch.collect()) == [("a", 0, 2), ("a", 5, 1), ("b", 0, 1)]
    assert tumbling(spark.read.parquet(src), "at", "1 minute", ["k"], slide="30 seconds").count() > batch.count()
    s = sessions(spark.read.parquet(src), "at", "1 minute", ["k"])
    assert sorted((r.k, r.n) for r in s.collect()) == [("a", 1), ("a", 2), ("b", 1)]
    live = tumbling(spark.readStream.schema(schema).parquet(src), "at", "1 minute", ["k"], late="1 minute")
    q = live.writeStream.format("memory").queryName("w").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.k, r.n) for r in spark.table("w").collect()) == [("a", 2), ("b", 1)]
