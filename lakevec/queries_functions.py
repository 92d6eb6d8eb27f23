"""Queries of functions that SQL can call, aggregates of one's own and variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import jsonfn, sqlfn
from .operators.aggregates import Moments, aggregate
from .registry import query, table


@query("""WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 hour THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
  SELECT event_id, user_id, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS session FROM g""")
def table_function(spark, d):
    """Sessions by a table function, called from SQL."""
    sqlfn.register(spark)
    rows = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return spark.sql("SELECT event_id, user_id, session FROM sessions_of(TABLE({rows}), 'user_id', 'ts', 21600)", rows=rows)


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <> 0 THEN CAST(l_extendedprice AS DOUBLE) * (1 - CAST(l_discount AS DOUBLE)) / CAST(l_quantity AS DOUBLE) END AS each
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'""")
def registered_functions(spark, d):
    """SQL text with registered functions, whose bodies are inlined."""
    sqlfn.register(spark)
    text = """SELECT l_orderkey, l_linenumber, unit_price(l_extendedprice, l_discount, l_quantity) AS each FROM {lines}
      WHERE half_open(CAST(l_shipdate AS TIMESTAMP), TIMESTAMP '1995-01-01', TIMESTAMP '1996-01-01')"""
    return spark.sql(text, lines=table(spark, d, "lineitem"))


@query("""WITH m AS (SELECT event_type, avg(CAST(value AS DOUBLE)) AS mean FROM events GROUP BY 1)
  SELECT e.event_type, round(sqrt(count(*)) * sum(pow(value - mean, 3)) / pow(sum(pow(value - mean, 2)), 1.5), 6) AS skew FROM events e JOIN m ON e.event_type = m.event_type WHERE value IS NOT NULL GROUP BY 1""")
def mergeable_aggregate(spark, d):
    """The skewness of each kind's values, by an aggregate whose buffers are merged."""
    return aggregate(table(spark, d, "events"), ["event_type"], "value", Moments(), "skew").withColumn("skew", F.round("skew", 6))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS text, CAST(NULL AS DOUBLE) AS none FROM events")
def variant_paths(spark, d):
    """Three paths of a JSON column that is parsed once."""
    events = table(spark, d, "events").select("event_id", "props")
    return jsonfn.extract(events, "props", {"k": ("$.k", "bigint"), "text": ("$.k", "string"), "none": ("$.missing.deeper[0]", "double")}).drop("props")
