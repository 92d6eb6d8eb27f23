"""Queries of streams: keyed state, joins of streams, the transactional sink. Each settles to what SQL gives in one go."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import storage
from .registry import query, table
from .sources import ledger
from .streaming import settle
from .streaming.keyed import join_within, live_changes, settled


def _arrivals(spark, d, name: str, columns, part):
    """(folder, stream, function that lets the next third of the events arrive)."""
    events, base = columns(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))), storage.scratch(spark, name)
    events.where("false").drop("_part").write.parquet(f"{base}/in")
    live = spark.readStream.schema(events.drop("_part").schema).parquet(f"{base}/in")

    def arrive(i: int) -> None:
        events.where(part == i).drop("_part").write.mode("append").parquet(f"{base}/in")

    return base, live, arrive


@query("""WITH r AS (SELECT user_id, max({'ts': epoch_us(ts), 'v': CAST(event_id AS VARCHAR)}) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1),
  x AS (SELECT user_id, max(epoch_us(ts)) AS deleted FROM events WHERE event_type = 'click' AND event_id % 40 = 0 GROUP BY 1)
  SELECT CAST(r.user_id AS VARCHAR) AS pk, r.m.ts AS ts, r.m.v AS value FROM r LEFT JOIN x ON r.user_id = x.user_id WHERE deleted IS NULL OR r.m.ts > deleted""")
def stream_live_keys(spark, d):
    """Rows and deletes in three arrivals without any order in time; the live row of each key at the end."""
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    wanted = lambda e: e.where("event_type = 'purchase' OR event_type = 'click' AND event_id % 40 = 0")
    base, live, arrive = _arrivals(spark, d, "live-keys", wanted, part)
    rows = live.withColumns({"at": F.unix_micros("ts"), "gone": F.col("event_type") == "click"})
    changes = live_changes(spark, rows, "user_id", "at", "gone", "event_id")
    for i in range(3):
        arrive(i)
        settle(changes, f"{base}/out", f"{base}/state")
    return settled(spark.read.parquet(f"{base}/out"))


@query("""SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 2 hour
  WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def stream_join(spark, d):
    """Clicks with the purchases of the same user within two hours, two streams that arrive by thirds."""
    span = table(spark, d, "events").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    part = F.least(F.floor((F.unix_micros("ts") - F.lit(span[0])) * 3 / (span[1] - span[0] + 1)), F.lit(2))
    base, live, arrive = _arrivals(spark, d, "stream-join", lambda e: e, part)
    clicks = live.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("clicked"))
    purchases = live.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought"))
    both = join_within(clicks, purchases, ["user_id"], "clicked", "bought", "2 HOURS", "1 day")
    for i in range(3):
        arrive(i)
        settle(both.select("click_id", "purchase_id", "user_id"), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_to_ledger(spark, d):
    """Events streamed by thirds into the transactional table; the last epoch is written twice, as after a crash."""
    ledger.register(spark)
    base, live, arrive = _arrivals(spark, d, "ledger", lambda e: e.select("event_id", "user_id", "event_type", "value", "ts"), F.pmod(F.xxhash64("event_id"), F.lit(3)))
    rows = live.select("event_id", "user_id", "event_type", "value")
    for i in range(3):
        arrive(i)
        sink = rows.writeStream.format("ledger").option("path", f"{base}/table").option("writer", "events").option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
        sink.start().awaitTermination()
    log = ledger.Log(f"{base}/table")
    last = log.entry(log.versions()[-1])
    log.commit(last["add"], last["schema"], writer="events", epoch=last["epochs"]["events"])
    return ledger.read_snapshot(spark, f"{base}/table")
