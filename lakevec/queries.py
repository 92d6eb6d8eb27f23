"""The library's operators as driver queries: ``QUERIES`` and their DuckDB equivalents ``ORACLE_SQL``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage
from .catalog import Catalog, write_collection
from .functions import distance, hashing, jsonfn, vectors
from .operators import deletes, keys, stats, topk, zipjoin
from .operators.asof import asof_join
from .plans import collection as plans
from .registry import ORACLE_SQL, QUERIES, query, table as _t
from .sinks import column_log, rows_json as json_sink
from .sources import logs, rows_json as json_source
from .streaming import sessions, settle, tumbling
from .types import CollectionSchema, Field, FieldType

_LINE = ["l_orderkey", "l_linenumber", "l_returnflag"]
_LINE_SQL = "l_orderkey, l_linenumber, l_returnflag"

# --- deletes


@query(f"SELECT {_LINE_SQL} FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey)")
def segment_delete_anti(spark, d):
    gone = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("pk"))
    return deletes.delete_keys(_t(spark, d, "lineitem").select(*_LINE), gone, "l_orderkey")


def _orders_as_deletes(spark, d, where: str = "true", partition: str | None = None):
    rows = _t(spark, d, "orders").where(where)
    rows = rows.withColumn("_part", F.expr(partition)) if partition else rows
    return deletes.keyed(rows.withColumn("_us", F.unix_micros(F.col("o_orderdate").cast("timestamp"))), "o_orderkey", "_us", "bigint", partition="_part" if partition else None)


def _lines(spark, d):
    return _t(spark, d, "lineitem").select(*_LINE, F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("_ts"), F.ascii("l_returnflag").cast("long").alias("_part"))


@query(f"SELECT {_LINE_SQL} FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_shipdate <= o_orderdate)")
def l0_delete_filter(spark, d):
    gone = deletes.consolidate(_orders_as_deletes(spark, d))
    return deletes.apply(_lines(spark, d), gone, "l_orderkey", "_ts").select(*_LINE)


@query(f"""SELECT {_LINE_SQL} FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_shipdate <= o_orderdate
  AND ascii(l_returnflag) = CASE WHEN o_orderkey % 2 = 0 THEN 65 ELSE 78 END)""")
def l0_partition_delete(spark, d):
    gone = deletes.consolidate(_orders_as_deletes(spark, d, partition="if(o_orderkey % 2 = 0, 65, 78)"))
    return deletes.apply(_lines(spark, d), gone, "l_orderkey", "_ts", "_part").select(*_LINE)


@query(f"""SELECT {_LINE_SQL} FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_shipdate <= o_orderdate
  AND (o_orderstatus = 'O' AND ascii(l_returnflag) = 78 OR o_orderstatus = 'F' AND ascii(l_returnflag) IN (65, 78, 82)))""")
def l0_combined_delete(spark, d):
    gone = deletes.consolidate(_orders_as_deletes(spark, d, "o_orderstatus = 'O'", "78"), _orders_as_deletes(spark, d, "o_orderstatus = 'F'"))
    return deletes.apply(_lines(spark, d), gone, "l_orderkey", "_ts", "_part").select(*_LINE)


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_version(spark, d):
    return deletes.latest(_t(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


# --- joins and set operations


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal, o_orderkey, o_orderstatus, o_totalprice FROM orders")
def positional_zip(spark, d):
    rows = zipjoin.with_ordinal(_t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey"], "ordinal")
    return zipjoin.zip_columns([rows.select("ordinal", c) for c in ("o_orderkey", "o_orderstatus", "o_totalprice")], "ordinal")


@query("SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_enrich(spark, d):
    side = _t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return _t(spark, d, "customer").join(side, ["c_nationkey"], "left").select("c_custkey", "c_name", "n_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def common_key_join(spark, d):
    buyers = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, d, "customer").select("c_custkey", "c_name").join(buyers, "c_custkey", "left_semi")


@query("SELECT coalesce(o_orderkey, -1) AS o_orderkey, coalesce(c_custkey, -1) AS c_custkey, c_name FROM customer FULL JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey")
def full_join(spark, d):
    urgent = _t(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    c = _t(spark, d, "customer")
    return c.join(urgent, c.c_custkey == urgent.o_custkey, "full").select(F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"), F.coalesce("c_custkey", F.lit(-1)).alias("c_custkey"), "c_name")


@query("""SELECT e.event_id, e.user_id, p.value AS value_right FROM (SELECT * FROM events WHERE event_type = 'click') e
  ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL) p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def asof_event(spark, d):
    e = _t(spark, d, "events")
    right = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return asof_join(e.where("event_type = 'click'").select("event_id", "user_id", "ts", "value"), right, ["user_id"], "ts", ["value"]).select("event_id", "user_id", "value_right")


@query("""WITH e AS (SELECT event_id, event_type, value, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts FROM events)
  SELECT l.event_id, p.value AS value_right FROM (SELECT * FROM e WHERE event_type = 'click') l
  ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM e WHERE event_type = 'purchase' AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL) p ON l.user_id = p.user_id AND l.ts >= p.ts""")
def asof_nulls(spark, d):
    """Null keys and times match nothing; of right rows of one time the largest value counts."""
    e = _t(spark, d, "events").withColumns({"user_id": F.when(F.col("event_id") % 5 != 0, F.col("user_id")), "ts": F.when(F.col("event_id") % 7 != 0, F.col("ts"))})
    sides = [e.where(F.col("event_type") == x) for x in ("click", "purchase")]
    return asof_join(sides[0].select("event_id", "user_id", "ts", "value"), sides[1], ["user_id"], "ts", ["value"]).select("event_id", "value_right")


_A, _B = "o_orderpriority = '1-URGENT'", "o_orderpriority = '5-LOW'"


def _sides(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("pk"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ts"), "o_orderpriority")
    return o.where(_A), o.where(_B)


@query(f"""WITH u AS (SELECT o_custkey AS pk, epoch_us(o_orderdate) AS ts, 'file1' AS source FROM orders WHERE {_A} UNION ALL SELECT o_custkey, epoch_us(o_orderdate), 'file2' FROM orders WHERE {_B})
  SELECT pk, string_agg(CAST(ts AS VARCHAR), ',' ORDER BY ts, source) AS timestamps, string_agg(source, ',' ORDER BY ts, source) AS sources, min(ts) AS min_ts, max(ts) AS max_ts
  FROM u GROUP BY pk HAVING count(DISTINCT source) = 2""")
def compare_keys(spark, d):
    out = keys.compare(*_sides(spark, d))
    return out.select("pk", F.array_join("timestamps", ",").alias("timestamps"), F.array_join("sources", ",").alias("sources"), "min_ts", "max_ts")


@query(f"SELECT o_custkey AS pk FROM orders WHERE {_A} INTERSECT SELECT o_custkey FROM orders WHERE {_B}")
def keys_common(spark, d):
    return keys.common(*_sides(spark, d))


@query(f"SELECT o_custkey AS pk FROM orders WHERE {_A} EXCEPT SELECT o_custkey FROM orders WHERE {_B}")
def keys_only_left(spark, d):
    return keys.only_left(*_sides(spark, d))


@query(f"SELECT o_custkey AS pk FROM orders WHERE {_B} EXCEPT SELECT o_custkey FROM orders WHERE {_A}")
def keys_only_right(spark, d):
    return keys.only_left(*reversed(_sides(spark, d)))


@query(f"""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE {_A}), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE {_B})
  SELECT (SELECT count(*) FROM a) AS left_keys, (SELECT count(*) FROM b) AS right_keys, (SELECT count(*) FROM a SEMI JOIN b USING (k)) AS common_keys,
  (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS only_left, (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS only_right""")
def key_counts(spark, d):
    return keys.counts(*_sides(spark, d))


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def except_all_keys(spark, d):
    o = _t(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").exceptAll(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT l_returnflag, l_orderkey, l_quantity FROM lineitem")
def union_segments(spark, d):
    rows = _t(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_quantity")
    parts = [rows.where(F.col("l_returnflag") == x) for x in ("A", "N")]
    return parts[0].union(parts[1]).union(rows.where("l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')"))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price FROM orders")
def union_by_name(spark, d):
    o = _t(spark, d, "orders")
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    b = o.where("o_orderstatus IS NULL OR o_orderstatus <> 'F'").select("o_orderstatus", "o_orderkey")
    return a.unionByName(b, allowMissingColumns=True)


# --- aggregates


@query("SELECT user_id AS pk, count(*) AS occurrence_count, min(ms) AS first_seen_ts, max(ms) AS last_seen_ts, max(ms) - min(ms) AS time_difference_ms FROM (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events) GROUP BY user_id")
def key_distribution(spark, d):
    e = _t(spark, d, "events").select("user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return keys.distribution(e, "user_id", "ms").orderBy(F.desc("occurrence_count"), "pk")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds FROM events")
def distinct_keys(spark, d):
    return _t(spark, d, "events").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("kinds"))


@query("SELECT user_id, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def group_count_top20(spark, d):
    return _t(spark, d, "events").groupBy("user_id").count().orderBy(F.desc("count"), "user_id").limit(20)


@query("SELECT min(epoch_us(ts)) AS min_ts, max(epoch_us(ts)) AS max_ts, count(*) AS n FROM events")
def minmax_ts(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return _t(spark, d, "events").agg(F.min(us).alias("min_ts"), F.max(us).alias("max_ts"), F.count("*").alias("n"))


@query("SELECT min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max FROM events")
def percentile_summary(spark, d):
    return stats.percentiles(_t(spark, d, "events"), "value")


@query("SELECT ts, count(*) AS n FROM (SELECT date_trunc('hour', ts) AS ts FROM events) GROUP BY ts")
def ts_histogram(spark, d):
    return _t(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("n"))


@query("""SELECT 'l_orderkey' AS "column", count(*) AS rows, count(l_orderkey) AS values, CAST(min(l_orderkey) AS VARCHAR) AS min, CAST(max(l_orderkey) AS VARCHAR) AS max FROM lineitem
  UNION ALL SELECT 'l_returnflag', count(*), count(l_returnflag), min(l_returnflag), max(l_returnflag) FROM lineitem""")
def footer_stats(spark, d):
    return stats.column_stats(_t(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_sales(spark, d):
    return _t(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_sales(spark, d):
    return _t(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
  round(avg(l_quantity), 6) AS avg_qty, count(*) AS count_order FROM lineitem GROUP BY ALL""")
def pricing_summary(spark, d):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"), F.round(F.sum(price), 2).alias("sum_disc_price"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("count_order"),
    )


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS window_start, time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_window(spark, d):
    return tumbling(_t(spark, d, "events"), "ts", "1 day", ["event_type"])


@query("""WITH g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 hour OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
  SELECT min(ts) AS session_start, max(ts) + INTERVAL 6 hour AS session_end, user_id, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark, d):
    return sessions(_t(spark, d, "events"), "ts", "6 hours", ["user_id"])


def _arrival(least, most):
    """1 to 3: the third of the time span in which a row comes; of every tenth user, rows come a third later."""
    third = F.floor((F.unix_micros("ts") - least) * 3 / (most - least + 1))
    return F.least(third + F.when(F.col("user_id") % 10 == 0, 2).otherwise(1), F.lit(3))


@query("""WITH s AS (SELECT min(epoch_us(ts)) AS least, max(epoch_us(ts)) AS most FROM events),
  a AS (SELECT ts, event_type, time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end,
    least(CAST(floor((epoch_us(ts) - least) * 3 / (most - least + 1)) AS INTEGER) + CASE WHEN user_id % 10 = 0 THEN 2 ELSE 1 END, 3) AS arrival FROM events, s),
  k AS (SELECT * FROM a WHERE window_end > coalesce((SELECT max(ts) - INTERVAL 2 day FROM a b WHERE b.arrival < a.arrival), TIMESTAMP '1970-01-01'))
  SELECT window_end - INTERVAL 1 hour AS window_start, window_end, event_type, count(*) AS n FROM k
  WHERE window_end <= (SELECT max(ts) - INTERVAL 2 day FROM a) GROUP BY ALL""")
def late_windows(spark, d):
    """Windows of a stream that gets all events in three arrivals; rows behind the watermark of earlier ones are dropped."""
    events, base = _t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), storage.scratch(spark, "late")
    span = events.select(F.unix_micros("ts").alias("at")).agg(F.min("at"), F.max("at")).first()
    events.where("false").write.parquet(f"{base}/in")
    live = spark.readStream.schema(events.schema).parquet(f"{base}/in")
    windows = tumbling(live, "ts", "1 hour", ["event_type"], late="2 days")
    for i in (1, 2, 3):
        events.where(_arrival(*map(F.lit, span)) == i).write.mode("append").parquet(f"{base}/in")
        settle(windows, f"{base}/out", f"{base}/state")
    plain = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return spark.read.parquet(f"{base}/out").select(plain("window_start"), plain("window_end"), "event_type", "n")


# --- projections and expressions


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_props(spark, d):
    return _t(spark, d, "events").select("event_id", jsonfn.field(F.col("props"), "k", "bigint").alias("k"))


@query("SELECT o_orderkey AS pk, CAST(o_orderkey AS BIGINT) * 10 AS ts FROM orders")
def json_pk_parse(spark, d):
    o = _t(spark, d, "orders").select(F.to_json(F.struct(F.col("o_orderkey").alias("pk"), (F.col("o_orderkey") * 10).alias("ts"))).alias("j"))
    return o.select(jsonfn.parse_key(F.col("j")).alias("r")).select("r.*")


@query("SELECT o_orderkey AS id, o_totalprice AS price, 'orders' AS source FROM orders")
def rename_project_drop(spark, d):
    return _t(spark, d, "orders").withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "price"}).withColumn("source", F.lit("orders")).drop("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus LIKE 'F%'")
def range_filter(spark, d):
    o = _t(spark, d, "orders")
    return o.where(o.o_totalprice.between(1000, 200000) & o.o_orderpriority.isin("1-URGENT", "2-HIGH") & o.o_orderstatus.startswith("F")).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_orders(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


# --- vectors

_V = "CAST(embedding AS DOUBLE[])"
_Q = f"(SELECT {_V} FROM embeddings WHERE vec_id = 7)"


def _vectors(spark, d):
    return _t(spark, d, "embeddings")


def _asked(spark, d) -> list[float]:
    return [float(x) for x in _vectors(spark, d).where("vec_id = 7").first()["embedding"]]


def _knn(metric: str):
    def run(spark, d):
        return topk.top_k(_vectors(spark, d), _asked(spark, d), 10, metric, "vec_id", "embedding").withColumn("score", F.round("score", 6))

    return run


for _name, _metric, _fn, _way in (("knn_l2", "L2", "list_distance", "ASC"), ("knn_ip", "IP", "list_inner_product", "DESC"), ("knn_cosine", "COSINE", "list_cosine_similarity", "DESC")):
    QUERIES[_name] = _knn(_metric)
    ORACLE_SQL[_name] = f"SELECT vec_id, round({_fn}({_V}, {_Q}), 6) AS score FROM embeddings ORDER BY {_fn}({_V}, {_Q}) {_way}, vec_id LIMIT 10"


@query(f"SELECT vec_id, round(list_distance({_V}, {_Q}), 6) AS score, label FROM embeddings WHERE label = 3 ORDER BY list_distance({_V}, {_Q}), vec_id LIMIT 10")
def knn_filtered(spark, d):
    rows = topk.top_k(_vectors(spark, d), _asked(spark, d), 10, "L2", "vec_id", "embedding", F.col("label") == 3, ["label"])
    return rows.withColumn("score", F.round("score", 6))


@query(f"""WITH p AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS s FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0)
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s, id) AS INTEGER) AS rank, id, round(s, 6) AS score FROM p QUALIFY rank <= 10""")
def knn_batch(spark, d):
    rows = _vectors(spark, d)
    return topk.batch_top_k(rows, rows.where("vec_id % 100 = 0"), 10, "L2", "vec_id", "embedding").withColumn("score", F.round("score", 6))


@query(f"SELECT label, vec_id, round(s, 6) AS score FROM (SELECT label, vec_id, list_distance({_V}, {_Q}) AS s FROM embeddings) QUALIFY row_number() OVER (PARTITION BY label ORDER BY s, vec_id) <= 3")
def knn_by_label(spark, d):
    from pyspark.sql import Window

    q = F.array(*[F.lit(x) for x in _asked(spark, d)])
    rows = _vectors(spark, d).select("label", "vec_id", distance.l2(F.col("embedding"), q).alias("s"))
    order = Window.partitionBy("label").orderBy("s", "vec_id")
    return rows.withColumn("r", F.row_number().over(order)).where("r <= 3").select("label", "vec_id", F.round("s", 6).alias("score"))


@query(f"""WITH q AS (SELECT unnest(range(64)) AS i, unnest({_V}) AS v FROM embeddings WHERE vec_id = 7), e AS (SELECT vec_id, unnest(range(64)) AS i, unnest({_V}) AS v FROM embeddings)
  SELECT vec_id, round(sum(e.v * q.v), 6) AS score FROM e JOIN q ON e.i = q.i WHERE e.v > 0 AND q.v > 0 GROUP BY vec_id ORDER BY sum(e.v * q.v) DESC, vec_id LIMIT 10""")
def sparse_ip(spark, d):
    sparse = F.map_from_entries(F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("long").alias("key"), x.alias("value"))), lambda e: e["value"] > 0))
    rows = _vectors(spark, d).select("vec_id", sparse.alias("vector"))
    query_ = {i: v for i, v in enumerate(_asked(spark, d)) if v > 0}
    return topk.sparse_top_k(rows, query_, 10, "vec_id").withColumn("score", F.round("score", 6))


@query(f"""WITH b AS (SELECT vec_id, list_transform({_V}, lambda x: CAST(x > 0 AS INTEGER)) AS s FROM embeddings), q AS (SELECT s FROM b WHERE vec_id = 7)
  SELECT b.vec_id, CAST(list_sum(list_transform(range(1, 65), lambda i: xor(b.s[i], q.s[i]))) AS INTEGER) AS score FROM b, q ORDER BY score, vec_id LIMIT 10""")
def hamming_topk(spark, d):
    bits = _vectors(spark, d).select("vec_id", vectors.sign_bits(F.col("embedding")).alias("s"))
    q = "".join("1" if x > 0 else "0" for x in _asked(spark, d))
    return bits.withColumn("score", distance.hamming(F.col("s"), F.lit(q))).orderBy("score", "vec_id").limit(10).select("vec_id", "score")


@query(ORACLE_SQL["hamming_topk"])
def hamming_bytes_topk(spark, d):
    """The same over packed bits."""
    bits = _vectors(spark, d).select("vec_id", vectors.sign_bytes(F.col("embedding")).alias("s"))
    asked = _asked(spark, d)
    q = int("".join("1" if x > 0 else "0" for x in asked), 2).to_bytes(len(asked) // 8, "big")
    return topk.top_k(bits, q, 10, "HAMMING", "vec_id", "s")


@query(f"""SELECT vec_id, round(list_inner_product({_V}, {_Q}), 6) AS score FROM embeddings WHERE vec_id % 10 NOT IN (3, 4, 5) ORDER BY list_inner_product({_V}, {_Q}) DESC, vec_id LIMIT 10""")
def knn_with_nan(spark, d):
    """Rows with a component that is not a number, infinite or null take no part."""
    odd = F.when(F.col("vec_id") % 10 == 3, float("nan")).when(F.col("vec_id") % 10 == 4, float("inf")).when(F.col("vec_id") % 10 != 5, F.col("embedding")[0])
    rows = _vectors(spark, d).select("vec_id", F.concat(F.array(odd.cast("float")), F.slice("embedding", 2, 63)).alias("embedding"))
    return topk.top_k(rows, _asked(spark, d), 10, "IP", "vec_id", "embedding").withColumn("score", F.round("score", 6))


@query(f"SELECT vec_id, round(sqrt(list_inner_product({_V}, {_V})), 6) AS norm, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings")
def vector_norm(spark, d):
    return _vectors(spark, d).select("vec_id", F.round(distance.norm(F.col("embedding")), 6).alias("norm"), F.size("embedding").alias("dim"))


@query("SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total FROM embeddings")
def vector_narrow(spark, d):
    wide = _vectors(spark, d).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return wide.select("vec_id", F.round(F.aggregate(vectors.narrow(F.col("v")), F.lit(0.0), lambda s, x: s + x.cast("double")), 5).alias("total"))


def _round_trip(write, read):
    def run(spark, d):
        back = _vectors(spark, d).select("vec_id", F.posexplode(read(write(F.col("embedding")))).alias("at", "x"))
        return back.select("vec_id", "at", F.round(F.col("x").cast("double"), 6).alias("x"))

    return run


QUERIES["f32_roundtrip"] = _round_trip(vectors.floats_to_le, vectors.floats_from_le)
ORACLE_SQL["f32_roundtrip"] = f"SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS at, round(unnest({_V}), 6) AS x FROM embeddings"
QUERIES["f32_be_roundtrip"] = _round_trip(vectors.floats_to_be, vectors.floats_from_be)
ORACLE_SQL["f32_be_roundtrip"] = ORACLE_SQL["f32_roundtrip"]
QUERIES["f16_roundtrip"] = _round_trip(vectors.floats_to_half, vectors.floats_from_half)
QUERIES["bf16_roundtrip"] = _round_trip(vectors.floats_to_bfloat, vectors.floats_from_bfloat)
# the step between neighbours is 2 ** (exponent - bits of the mantissa), and 2 ** -24 for halves below 2 ** -14
for _name, _bits, _least in (("f16_roundtrip", 10, -14), ("bf16_roundtrip", 7, -126)):
    _step = f"pow(2.0, greatest(floor(log2(abs(x))), {_least}) - {_bits})"
    ORACLE_SQL[_name] = f"""WITH e AS (SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS i, unnest({_V}) AS x FROM embeddings)
      SELECT vec_id, i AS at, round(CASE WHEN x = 0 THEN 0 ELSE round_even(x / {_step}, 0) * {_step} END, 6) AS x FROM e"""


@query(f"SELECT vec_id, k, round(x, 6) AS x FROM (SELECT vec_id, unnest(range(64)) AS k, unnest({_V}) AS x FROM embeddings) WHERE x > 0")
def sparse_roundtrip(spark, d):
    text = F.to_json(F.map_from_entries(F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value"))), lambda e: e["value"] > 0)))
    back = _vectors(spark, d).select("vec_id", vectors.sparse_from_bytes(vectors.sparse_to_bytes(vectors.sparse_from_json(text))).alias("m"))
    return back.select("vec_id", F.explode("m").alias("k", "x")).select("vec_id", "k", F.round(F.col("x").cast("double"), 6).alias("x"))


# --- hashes

_M = 4294967295
_ROT = lambda x, r: f"((({x}) << {r}) | (({x}) >> {32 - r})) & {_M}"


def _mix(x: str) -> str:
    return f"(({_ROT(f'({x} * 3432918353) & {_M}', 15)}) * 461845907) & {_M}"


@query(f"""WITH a AS (SELECT c_custkey, CAST(c_custkey AS UBIGINT) & {_M}::UBIGINT AS lo, CAST(c_custkey AS UBIGINT) >> 32 AS hi FROM customer),
  b AS (SELECT c_custkey, hi, {_mix('lo')} AS h FROM a), c AS (SELECT c_custkey, hi, (({_ROT('h', 13)}) * 5 + 3864292196) & {_M} AS h FROM b),
  e AS (SELECT c_custkey, xor(h, {_mix('hi')}) AS h FROM c), f AS (SELECT c_custkey, xor((({_ROT('h', 13)}) * 5 + 3864292196) & {_M}, 8::UBIGINT) AS h FROM e),
  g AS (SELECT c_custkey, (xor(h, h >> 16) * 2246822507) & {_M} AS h FROM f), i AS (SELECT c_custkey, (xor(h, h >> 13) * 3266489909) & {_M} AS h FROM g),
  j AS (SELECT c_custkey, CAST(xor(h, h >> 16) & 2147483647 AS BIGINT) AS h FROM i)
  SELECT c_custkey, h AS hash, h % 8 AS shard FROM j""")
def int64_shard(spark, d):
    key = F.col("c_custkey")
    return _t(spark, d, "customer").select("c_custkey", hashing.hash_int64(key).alias("hash"), hashing.shard_of_int64(key, 8).alias("shard"))


@query("""WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS tab),
  h AS (SELECT c_custkey, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(c_name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS hash FROM customer, t)
  SELECT c_custkey, hash, hash % 8 AS shard FROM h""")
def crc_shard(spark, d):
    key = F.col("c_name")
    return _t(spark, d, "customer").select("c_custkey", hashing.hash_string(key).alias("hash"), hashing.shard_of_string(key, 8).alias("shard"))


# --- sources and sinks: written below the shared folder, read back

_ORDERS = CollectionSchema(
    "orders",
    (
        Field("o_orderkey", FieldType.INT64, 100, primary=True, nullable=False),
        Field("o_totalprice", FieldType.DOUBLE, 101),
        Field("o_orderstatus", FieldType.VARCHAR, 102, max_length=16),
    ),
)
_COLLECTION = 7


def _order_rows(spark, d):
    """Orders as segments: partition by status, a segment for about 5,000 keys; ts is the order's date in ms."""
    o = _t(spark, d, "orders")
    ts = F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("_ts")
    return o.select(F.ascii("o_orderstatus").cast("long").alias("partition_id"), (F.col("o_orderkey") / 5000).cast("long").alias("segment_id"), ts, *[f.name for f in _ORDERS.fields]).withColumn(
        "segment_id", F.col("partition_id") * 1_000_000 + F.col("segment_id")
    )


def _written(spark, d, name: str, nested: bool = False) -> str:
    base = storage.scratch(spark, name)
    under = f"{base}/binlogs" if nested else base
    column_log.write_files(column_log.encode_segments(_order_rows(spark, d), _ORDERS, _COLLECTION), under, _COLLECTION, nested=nested)
    return base


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, epoch_us(o_orderdate) // 1000 AS ts FROM orders")
def column_log_roundtrip(spark, d):
    base = _written(spark, d, "logs")
    rows = logs.read_segments(spark, f"{base}/insert_log/{_COLLECTION}", _ORDERS)
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("_ts").alias("ts"))


@query("SELECT ascii(o_orderstatus) AS partition_id, count(*) AS rows FROM orders GROUP BY 1")
def log_meta_rows(spark, d):
    base = _written(spark, d, "meta")
    meta = logs.read_meta(spark, f"{base}/insert_log/{_COLLECTION}")
    return meta.where("field_id = 100").groupBy(F.col("partition_id").cast("int").alias("partition_id")).agg(F.sum("rows").alias("rows"))


@query("SELECT count(*) AS rows, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders")
def log_footer_stats(spark, d):
    base = _written(spark, d, "stats")
    s = logs.read_stats(spark, f"{base}/insert_log/{_COLLECTION}").where("field_id = 100")
    return s.agg(F.sum("rows").alias("rows"), F.min(F.col("min").cast("long")).alias("least"), F.max(F.col("max").cast("long")).alias("most"))


def _delete_files(spark, d, base: str, nested: bool = False, within: str = "o_orderkey % 7 = 0", over: str = "o_orderkey % 11 = 0") -> None:
    o = _t(spark, d, "orders")
    ts = F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts")
    inside = o.where(within).select(F.ascii("o_orderstatus").cast("long").alias("partition_id"), F.lit(1).cast("long").alias("segment_id"), F.col("o_orderkey").alias("pk"), ts)
    wide = o.where(over).select(F.lit(-1).cast("long").alias("partition_id"), F.lit(2).cast("long").alias("segment_id"), F.col("o_orderkey").alias("pk"), (F.col("o_orderkey") % 2 * 4_000_000_000_000).alias("ts"))
    column_log.write_files(column_log.encode_deletes(inside.unionByName(wide), _COLLECTION), base, _COLLECTION, "delta_log", nested)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS pk, epoch_us(o_orderdate) // 1000 AS ts, CAST(ascii(o_orderstatus) AS BIGINT) AS partition_id FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderkey % 2 * 4000000000000, -1 FROM orders""")
def delta_log_roundtrip(spark, d):
    base = storage.scratch(spark, "deltas")
    _delete_files(spark, d, base, within="true", over="true")
    return logs.read_deletes(spark, f"{base}/delta_log/{_COLLECTION}").select("pk", "ts", "partition_id")


_LIVE = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0 AND NOT (o_orderkey % 11 = 0 AND o_orderkey % 2 = 1)"


@query(_LIVE)
def collection_read(spark, d):
    base = _written(spark, d, "live")
    _delete_files(spark, d, base)
    return plans.read_collection(spark, f"{base}", _ORDERS, _COLLECTION)


def _backup(spark, d) -> str:
    """A folder with a backup of the orders, their deletes and the backup's metadata."""
    import json

    base = _written(spark, d, "backup", nested=True)
    _delete_files(spark, d, f"{base}/binlogs", nested=True)
    rows = _order_rows(spark, d).groupBy("partition_id", "segment_id").count().collect()  # a row for each segment
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["partition_id"], []).append({"segment_id": r["segment_id"], "partition_id": r["partition_id"], "num_of_rows": r["count"]})
    for p, found in by.items():
        found.append({"segment_id": 1, "partition_id": p, "is_l0": True})
    fields = [{"fieldID": f.field_id, "name": f.name, "data_type": int(f.type), "is_primary_key": f.primary, "nullable": f.nullable} for f in _ORDERS.fields]
    tree = {
        "id": "1", "name": "b", "collection_backups": [{
            "collection_id": _COLLECTION, "db_name": "default", "collection_name": "orders", "schema": {"name": "orders", "fields": fields},
            "partition_backups": [{"partition_id": p, "partition_name": f"p{p}", "segment_backups": s} for p, s in by.items()],
            "l0_segments": [{"segment_id": 2, "partition_id": -1}],
        }],
    }
    spark.createDataFrame([(json.dumps(tree),)], "value string").coalesce(1).write.text(f"{base}/made")
    name = next(x for x in storage.list_files(spark, f"{base}/made") if x.endswith(".txt"))
    Catalog(spark, base)._write(f"{base}/meta/full_meta.json", Catalog(spark, base)._read(name))
    return base


@query(_LIVE)
def backup_restore(spark, d):
    return plans.read_backup_collection(spark, _backup(spark, d), "orders", "default")


@query(_LIVE)
def backup_restored_store(spark, d):
    root = storage.scratch(spark, "restored")
    plans.restore(spark, _backup(spark, d), "orders", root)
    return Catalog(spark, root).read("default", "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(f"SELECT l.*, n FROM ({_LIVE}) l LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) i ON o_orderkey = l_orderkey")
def backup_to_parquet(spark, d):
    out = storage.scratch(spark, "parquet")
    side = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    plans.backup_to_parquet(spark, _backup(spark, d), "orders", out, side, "o_orderkey", files=4)
    return spark.read.parquet(out).select("o_orderkey", "o_totalprice", "o_orderstatus", "n")


@query("SELECT o_orderkey AS val FROM orders")
def datasource_roundtrip(spark, d):
    from .sources import datasource

    datasource.register(spark)
    path = storage.scratch(spark, "column-log")
    _t(spark, d, "orders").select(F.col("o_orderkey").alias("val")).write.format("column_log").option("path", path).mode("append").save()
    return spark.read.format("column_log").load(path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def collection_source(spark, d):
    from .sources import datasource

    datasource.register(spark)
    root, rows = storage.scratch(spark, "store"), _t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    given = {"collection.name": "c", "collection.primaryKeyField": "c_custkey"}
    rows.write.format("collection").options(**given).mode("append").save(root)
    return spark.read.format("collection").options(**given).load(root).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey >= (SELECT max(c_custkey) // 2 FROM customer) AND c_name IS NOT NULL")
def collection_source_filtered(spark, d):
    """Two of three columns are read, then filtered."""
    from .sources import datasource

    datasource.register(spark)
    root, rows = storage.scratch(spark, "store"), _t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    given = {"collection.name": "c", "collection.primaryKeyField": "c_custkey", "insertMaxBatchSize": "1000"}
    rows.repartitionByRange("c_custkey").write.format("collection").options(**given).mode("append").save(root)
    half = rows.agg(F.expr("max(c_custkey) div 2")).first()[0]
    stored = spark.read.schema("c_custkey long, c_name string").format("collection").options(**given).load(root)
    return stored.where((F.col("c_custkey") >= half) & F.col("c_name").isNotNull())


@query("SELECT CAST(o_orderkey AS VARCHAR) AS pk, epoch_us(o_orderdate) // 1000 AS ts FROM orders")
def delete_logs_by_glob(spark, d):
    base = storage.scratch(spark, "glob")
    _delete_files(spark, d, base, within="true", over="false")
    return logs.read_deletes(spark, f"{base}/delta_log/{_COLLECTION}/*/1/*").select("pk", "ts")


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_lines_with_schema(spark, d):
    path = storage.scratch(spark, "json-lines")
    rows = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    rows.write.json(path)
    return json_source.read_rows(spark, path, rows.schema, wrapped=False)


@query("""SELECT o_orderkey, json_valid(CASE WHEN o_orderkey % 3 = 0 THEN '{"pk": ' || o_orderkey || '}' WHEN o_orderkey % 3 = 1 THEN '{"pk": ' || o_orderkey ELSE '[' || o_orderkey || ', null]' END) AS ok FROM orders""")
def json_validity(spark, d):
    text = F.expr("""CASE WHEN o_orderkey % 3 = 0 THEN '{"pk": ' || o_orderkey || '}' WHEN o_orderkey % 3 = 1 THEN '{"pk": ' || o_orderkey ELSE '[' || o_orderkey || ', null]' END""")
    return _t(spark, d, "orders").select("o_orderkey", jsonfn.valid(text).alias("ok"))


# --- joins, sets, SQL text, functions and aggregates of one's own


@query("SELECT l_orderkey AS k FROM lineitem INTERSECT ALL SELECT o_orderkey FROM orders")
def intersect_all_keys(spark, d):
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).intersectAll(_t(spark, d, "orders").select("o_orderkey"))


@query("SELECT c_custkey, count(o_orderkey) AS orders FROM orders RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def right_join(spark, d):
    both = _t(spark, d, "orders").join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "right")
    return both.groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"))


_TEXT = "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS most FROM {orders} WHERE o_orderdate >= DATE '1995-01-01' GROUP BY o_orderpriority HAVING count(*) > 1"


@query(_TEXT.replace("{orders}", "orders"))
def sql_text(spark, d):
    return spark.sql(_TEXT, orders=_t(spark, d, "orders"))


@query("SELECT c_mktsegment, round(exp(avg(ln(abs(c_acctbal) + 1))), 4) AS geometric FROM customer GROUP BY 1")
def own_aggregate(spark, d):
    return _t(spark, d, "customer").groupBy("c_mktsegment").agg(F.round(stats.geometric_mean(F.abs("c_acctbal") + 1), 4).alias("geometric"))


@query("""SELECT c_custkey, upper(substr(c_name, 1, 4)) || '-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, length(c_name) AS size,
  floor(abs(c_acctbal)) AS whole, CAST(round(sqrt(abs(c_acctbal)), 4) AS DOUBLE) AS root FROM customer""")
def scalar_functions(spark, d):
    bal = F.abs(F.col("c_acctbal").cast("double"))
    code = F.concat(F.upper(F.substring("c_name", 1, 4)), F.lit("-"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    return _t(spark, d, "customer").select("c_custkey", code.alias("code"), F.length("c_name").cast("long").alias("size"), F.floor(bal).cast("double").alias("whole"), F.round(F.sqrt(bal), 4).alias("root"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def rows_json_roundtrip(spark, d):
    path = storage.scratch(spark, "rows-json")
    rows = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    json_sink.write_rows(rows, path)
    return json_source.read_rows(spark, path, rows.schema)


@query("SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings")
def collection_append(spark, d):
    root = storage.scratch(spark, "catalog")
    write_collection(_vectors(spark, d), root, {"collection.name": "v", "collection.primaryKeyField": "vec_id", "collection.vectorField": "embedding", "collection.vectorDim": 64})
    return Catalog(spark, root).read("default", "v").select("vec_id", "label", F.size("embedding").alias("dim"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def bulk_import(spark, d):
    root = storage.scratch(spark, "import")
    rows = _t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows.repartition(3).write.parquet(f"{root}/files")
    catalog = Catalog(spark, f"{root}/store")
    catalog.ensure("default", CollectionSchema.from_struct("c", rows.schema, "c_custkey"))
    catalog.bulk_import("default", "c", f"{root}/files")
    return catalog.read("default", "c")


@query(f"SELECT vec_id, round(list_inner_product({_V}, {_Q}), 6) AS score FROM embeddings ORDER BY list_inner_product({_V}, {_Q}) DESC, vec_id LIMIT 10")
def collection_search(spark, d):
    root = storage.scratch(spark, "search")
    write_collection(_vectors(spark, d), root, {"collection.name": "v", "collection.primaryKeyField": "vec_id", "collection.vectorField": "embedding", "collection.vectorDim": 64})
    catalog = Catalog(spark, root)
    catalog.create_index("default", "v", "embedding", "IP")
    return catalog.search("default", "v", "embedding", _asked(spark, d)).withColumn("score", F.round("score", 6))


@query("SELECT item_id, CAST(32 AS INTEGER) AS dim FROM benchmark")
def text_embedding(spark, d):
    from .plans.embed import embed

    docs = _t(spark, d, "benchmark").select("item_id", "text")
    return embed(docs, dim=32).select("item_id", F.size("vector").alias("dim"))


from . import queries_functions, queries_indexes, queries_joins, queries_sources, queries_streams  # noqa: E402, F401  they register their queries
