"""Table functions, registered functions, mergeable aggregates, variants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevec.functions import jsonfn, sqlfn
from lakevec.operators import aggregates


def test_sessions(spark):
    sqlfn.register(spark)
    rows = spark.sql("SELECT k, timestamp_seconds(s) AS at, v FROM VALUES ('a', 0, 1), ('a', 50, 2), ('a', 200, 3), ('b', 10, 4), ('a', NULL, 5), (NULL, 7, 6) AS t(k, s, v)")
    found = spark.sql("SELECT * FROM sessions_of(TABLE({rows}), 'k', 'at', 100)", rows=rows)
    assert found.columns == ["k", "at", "v", "session"]  # what comes out follows from what goes in
    assert {r.v: r.session for r in found.collect()} == {1: 1, 2: 1, 3: 2, 4: 1, 5: 0, 6: 1}
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM sessions_of(TABLE({rows}), 'x', 'at', 100)", rows=rows)


def test_bodies(spark):
    sqlfn.register(spark)
    assert spark.sql("SELECT unit_price(10, 0.5, 2), unit_price(1, 0, 0), key_shard('abc', 8), half_open(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01')").first()[:] == (2.5, None, 2, False)


def test_buffers_merge(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "HELD", 2)
    r = np.random.default_rng(1)
    rows = [(k, float(v) + 1e6) for k in ("a", "b", None, "hot", "hot", "hot") for v in r.gamma(2, size=60)] + [("none", None), ("one", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {x.k: x.s for x in aggregates.aggregate(df, ["k"], "v", aggregates.Moments(), "s").collect()}
    want = {x.k: x.s for x in df.where("v IS NOT NULL").groupBy("k").agg(F.skewness("v").alias("s")).collect()}
    assert got.keys() == want.keys() == {"a", "b", None, "hot", "one"} and got["one"] is None
    assert all(abs(got[k] - want[k]) < 1e-6 for k in got if k != "one")
    assert aggregates.aggregate(df.limit(0), ["k"], "v", aggregates.Moments(), "s").count() == 0


def test_variants_are_parsed_once(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2.5]}, "t": "x"}',), ("no json",), (None,), ('{"a": {"b": "text"}}',)], "j string")
    found = jsonfn.extract(df, "j", {"first": ("$.a.b[0]", "int"), "second": ("$.a.b[1]", "double"), "t": ("$.t", "string")})
    assert [r[1:] for r in found.collect()] == [(1, 2.5, "x"), (None,) * 3, (None,) * 3, (None,) * 3]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1, plan
    assert "b" in jsonfn.variant_schema(df, "j") and "t: STRING" in jsonfn.variant_schema(df, "j")
