"""The live state of keys over a stream of rows and deletes, and joins of two streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
CHANGES = "pk string, change long, live boolean, ts long, value string"
_STATE = T.StructType([T.StructField("ts", T.LongType()), T.StructField("value", T.StringType()), T.StructField("deleted", T.LongType()), T.StructField("change", T.LongType()), T.StructField("live", T.BooleanType())])


class LiveKeys(StatefulProcessor):
    """One state for each key: its latest row, its latest delete, and whether the row lives, which it does if it is later
    than the delete. Rows and deletes may come in any order. With ``expires``, a key that is deleted is forgotten by a timer
    once the watermark has passed its delete: what the delete would still remove can't come any more."""

    def __init__(self, expires: bool = False):
        self.expires = expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("live", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ts, value, deleted, change, live = self.state.get() if self.state.exists() else (None, None, None, 0, False)
        before = (live, ts, value)
        for part in rows:
            for is_delete, at, v in zip(part["is_delete"], part["ts"], part["value"], strict=True):
                at, v = int(at), None if pd.isna(v) else v
                if is_delete:
                    deleted = at if deleted is None else max(deleted, at)
                elif ts is None or (at, v or "") > (ts, value or ""):
                    ts, value = at, v
        live = ts is not None and (deleted is None or ts > deleted)
        changed = (live, ts, value) != before and (live or before[0])
        change += changed
        self.state.update((ts, value, deleted, change, live))
        if self.expires and not live and deleted is not None:
            self.handle.registerTimer(deleted // 1000 + 1)
        yield pd.DataFrame({"pk": [key[0]], "change": [change], "live": [live], "ts": [ts], "value": [value]}).astype({"ts": "Int64"}) if changed else _none()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            _, _, deleted, _, live = self.state.get()
            if not live and deleted // 1000 < expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
        yield _none()

    def close(self) -> None:
        pass


def _none() -> pd.DataFrame:
    return pd.DataFrame({"pk": pd.Series([], dtype=object), "change": pd.Series([], dtype="int64"), "live": pd.Series([], dtype=bool), "ts": pd.Series([], dtype="Int64"), "value": pd.Series([], dtype=object)})


def live_changes(spark: SparkSession, stream: DataFrame, pk: str, ts: str, is_delete: str, value: str, late: str | None = None) -> DataFrame:
    """CHANGES of a stream of rows and deletes (``is_delete``): whenever a key's live row becomes another one, appears or
    goes, a row with the number of the change. ``settled`` makes the live table of them. ``ts`` counts microseconds. Rows
    without a key or time are left out. With a watermark of ``late``, rows behind it are dropped and deleted keys forgotten;
    without one any delay is allowed and nothing is. State is kept by RocksDB, by key, on the executors' disks with
    checkpoints, and isn't bounded by their memory."""
    spark.conf.set(*_STORE)
    rows = stream.select(F.col(pk).cast("string").alias("pk"), F.col(ts).cast("long").alias("ts"), F.col(is_delete).alias("is_delete"), F.col(value).cast("string").alias("value")).where("pk IS NOT NULL AND ts IS NOT NULL AND is_delete IS NOT NULL")
    if late:
        rows = rows.withColumn("_at", F.timestamp_micros("ts")).withWatermark("_at", late)
    return rows.groupBy("pk").transformWithStateInPandas(LiveKeys(late is not None), CHANGES, "Append", "EventTime" if late else "None")


def settled(changes: DataFrame) -> DataFrame:
    """(pk, ts, value) of the keys that live after all changes."""
    last = changes.groupBy("pk").agg(F.max_by(F.struct("live", "ts", "value"), "change").alias("l"))
    return last.where("l.live").select("pk", "l.ts", "l.value")


def join_within(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, within: str, late: str) -> DataFrame:
    """Rows of two streams with equal ``by`` of which the right one comes from the left one's time on, up to ``within`` later.

    Both sides have a watermark of ``late``; a row is kept no longer than until the other side's watermark rules a partner
    out. Columns of both sides, ``by`` once; names may not clash otherwise."""
    a, b = left.withWatermark(left_ts, late), right.withWatermark(right_ts, late).withColumnsRenamed({c: f"_r_{c}" for c in by})
    on = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}"))
    for c in by:
        on = on & (F.col(c) == F.col(f"_r_{c}"))
    return a.join(b, on).drop(*[f"_r_{c}" for c in by])
