"""Streams: delete logs as they arrive, windows over events, the live state of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.logs import decode_deletes

_BINARY = "path string, modificationTime timestamp, length long, content binary"


def stream_deletes(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """The records of delete logs as their files appear in ``folder``."""
    raw = spark.readStream.format("binaryFile").schema(_BINARY).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return decode_deletes(raw.select("path", "content"))


def tumbling(events: DataFrame, ts: str, width: str, by: list[str], late: str | None = None, slide: str | None = None) -> DataFrame:
    """Counts per window and key; ``late`` is the watermark of a stream."""
    rows = events.withWatermark(ts, late) if late else events
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return rows.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def sessions(events: DataFrame, ts: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    rows = events.withWatermark(ts, late) if late else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def latest_deletes(stream: DataFrame) -> DataFrame:
    """The latest delete of each key so far; write in update mode."""
    return stream.groupBy("pk", "partition_id").agg(F.max("ts").alias("ts"))


def settle(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what ``stream`` yields for all that has arrived by now to the Parquet table ``path``.

    A further call with the same ``checkpoint`` goes on where this one stopped: results are written once, and rows
    behind the watermark of what was there before are dropped.
    """
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
