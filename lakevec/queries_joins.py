"""Queries of the joins and aggregates that Spark has no operator for."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .operators.asof import asof_join
from .operators.interval import interval_aggregate, interval_join
from .operators.quantiles import quantiles
from .operators.scan import range_frame, scan
from .registry import query, table

_WINDOWS = "SELECT event_id AS window_id, user_id, ts AS opened, ts + to_hours(CAST(1 + event_id % 40 AS INTEGER)) AS closed FROM events WHERE event_type = 'purchase'"


def _windows(events):
    opened = F.col("ts").cast("timestamp")
    closed = opened + F.make_interval(hours=1 + F.col("event_id") % 40)
    return events.where("event_type = 'purchase'").select(F.col("event_id").alias("window_id"), "user_id", opened.alias("opened"), closed.alias("closed"))


@query(f"SELECT e.event_id, e.user_id, w.window_id FROM events e JOIN ({_WINDOWS}) w ON e.user_id = w.user_id AND e.ts >= w.opened AND e.ts < w.closed")
def interval_join_keyed(spark, d):
    """All events of a user within that user's windows, which overlap and differ in length."""
    events = table(spark, d, "events")
    points = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return interval_join(points, _windows(events), "ts", "opened", "closed", ["user_id"]).select("event_id", "user_id", "window_id")


@query(f"""SELECT e.event_type, count(*) AS events, count(w.window_id) AS held, count(DISTINCT w.window_id) AS windows FROM events e
  LEFT JOIN ({_WINDOWS}) w ON e.ts >= w.opened AND e.ts < w.closed AND w.window_id % 50 = 0 GROUP BY 1""")
def interval_join_unkeyed(spark, d):
    """Events within anyone's windows of some kind, without a key; events outside all windows stay."""
    events = table(spark, d, "events")
    points = events.select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    both = interval_join(points, _windows(events).where("window_id % 50 = 0"), "ts", "opened", "closed", how="left")
    return both.groupBy("event_type").agg(F.count("*").alias("events"), F.count("window_id").alias("held"), F.count_distinct("window_id").alias("windows"))


@query("""SELECT p.p_partkey, count(*) AS n, max(b.low) AS low FROM part p JOIN (SELECT c_custkey, floor(abs(c_acctbal)) AS low, floor(abs(c_acctbal)) + c_custkey % 200 AS high FROM customer) b
  ON p.p_retailprice >= b.low AND p.p_retailprice < b.high GROUP BY 1""")
def interval_join_prices(spark, d):
    """Prices in ranges of numbers: how many hold a price, and where the last of them begins."""
    size = F.abs("c_acctbal").cast("double")
    low = F.when(size < 2.0**52, F.floor(size).cast("double")).otherwise(size)  # whole from there on; NaN and infinity stay
    ranges = table(spark, d, "customer").select(low.alias("low"), (low + F.col("c_custkey") % 200).alias("high"))
    prices = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").cast("double").alias("price"))
    held = interval_aggregate(prices, ranges, "price", "low", "high", {"n": ("count", "*"), "low": ("max", "low")})
    return held.groupBy("p_partkey").agg(F.sum("n").alias("n"), F.max("low").alias("low"))


_AT = (0.01, 0.25, 0.5, 0.75, 0.999)
_QUANTILES = """SELECT '{c}' AS "column", count({c}) AS rows, CAST(min({c}) AS DOUBLE) AS min, {at}, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
_QUANTILE_SQL = " UNION ALL ".join(
    _QUANTILES.format(c=c, at=", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS p{round(100 * p, 4):g}".replace("p99.9", "p99_9") for p in _AT))
    for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
)


@query(_QUANTILE_SQL)
def exact_quantiles(spark, d):
    """Exact quantiles of four columns at once, by counts of digits."""
    columns = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"]
    lines = table(spark, d, "lineitem").select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in columns[1:]])
    found = quantiles(lines, columns, _AT)
    return found.select("column", "rows", "min", *[F.round(c, 6).alias(c) for c in found.columns[3:-1]], "max")


@query("""SELECT event_id, u, row_number() OVER w AS row_number, rank() OVER r AS rank, dense_rank() OVER r AS dense_rank, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 4) AS running_sum, lag(value) OVER w AS previous
  FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS u, date_trunc('hour', ts) AS h, CAST(value AS DOUBLE) AS value FROM events)
  WINDOW w AS (PARTITION BY u ORDER BY h, event_id), r AS (PARTITION BY u ORDER BY h)""")
def hot_key_windows(spark, d):
    """Ranks, running sums and previous values where one user has a third of all events."""
    u = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).cast("long")
    rows = table(spark, d, "events").select("event_id", u.alias("u"), F.date_trunc("hour", "ts").alias("h"), F.col("value").cast("double").alias("value"))
    found = scan(rows, ["u"], "h", "value", ["event_id"])
    return found.select("event_id", "u", "row_number", "rank", "dense_rank", F.round("running_sum", 4).alias("running_sum"), "previous")


_HOT = "SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS u, ts, value FROM events"


def _hot_events(spark, d):
    """Events of which one user has a third."""
    return table(spark, d, "events").withColumn("u", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).cast("long"))


@query(f"""WITH e AS ({_HOT}) SELECT event_id, u, CAST(count(*) OVER w AS BIGINT) AS frame_count, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS frame_sum
  FROM e WINDOW w AS (PARTITION BY u ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW)""")
def hot_key_range_frames(spark, d):
    """Events and cents of the day before each event, where one user has a third of all events."""
    rows = _hot_events(spark, d).select("event_id", "u", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    return range_frame(rows, ["u"], "at", "cents", 86_400_000_000).drop("at", "cents")


@query(f"""WITH e AS ({_HOT}) SELECT l.event_id, l.u, p.value AS purchased, p.event_id AS purchase_id FROM (SELECT * FROM e WHERE event_type <> 'purchase') l
  ASOF LEFT JOIN (SELECT u, ts, max(value) AS value, max_by(event_id, (value, event_id)) AS event_id FROM e WHERE event_type = 'purchase' GROUP BY ALL) p ON l.u = p.u AND l.ts >= p.ts""")
def asof_hot_key(spark, d):
    """The last purchase before each other event, where one user has a third of all events."""
    e = _hot_events(spark, d)
    bought = e.where("event_type = 'purchase'").select("u", "ts", F.col("value").alias("purchased"), F.col("event_id").alias("purchase_id"))
    return asof_join(e.where("event_type <> 'purchase'").select("event_id", "u", "ts"), bought, ["u"], "ts", ["purchased", "purchase_id"]).drop("ts")


@query("""SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level, count(*) AS lines, count(DISTINCT l_suppkey) AS suppliers, CAST(sum(l_quantity) AS DOUBLE) AS quantity
  FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())""")
def grouping_sets_lines(spark, d):
    lines = table(spark, d, "lineitem")
    sets = [("l_returnflag", "l_linestatus"), ("l_linestatus",), ()]
    return lines.groupingSets([[F.col(c) for c in s] for s in sets], "l_returnflag", "l_linestatus").agg(
        F.grouping_id().alias("level"), F.count("*").alias("lines"), F.count_distinct("l_suppkey").alias("suppliers"), F.sum("l_quantity").cast("double").alias("quantity")
    )


@query("""SELECT o_orderkey, rank() OVER p AS rank, ntile(4) OVER w AS quarter, round(percent_rank() OVER p, 9) AS place, lag(o_totalprice, 2) OVER w AS before, lead(o_orderkey) OVER w AS next_key,
  first_value(o_totalprice) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING) AS first_near, count(*) OVER (PARTITION BY o_custkey ORDER BY epoch_us(o_orderdate) // 86400000000 RANGE BETWEEN 365 PRECEDING AND CURRENT ROW) AS year
  FROM orders WINDOW p AS (PARTITION BY o_custkey ORDER BY o_orderpriority), w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def order_windows(spark, d):
    """Ranks, tiles, neighbours and frames of a customer's orders: keys are small, so these are Spark's own windows."""
    days = F.unix_date(F.col("o_orderdate").cast("date"))
    c = Window.partitionBy("o_custkey")
    p, w = c.orderBy("o_orderpriority"), c.orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select(
        "o_orderkey", F.rank().over(p).alias("rank"), F.ntile(4).over(w).alias("quarter"), F.round(F.percent_rank().over(p), 9).alias("place"),
        F.lag("o_totalprice", 2).over(w).alias("before"), F.lead("o_orderkey").over(w).alias("next_key"),
        F.first("o_totalprice").over(w.rowsBetween(-3, 1)).alias("first_near"), F.count("*").over(c.orderBy(days).rangeBetween(-365, 0)).alias("year"),
    )
