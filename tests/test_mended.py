"""What once went wrong silently: large positional zips, odd vectors, nulls in as-of joins, overwrites, signs in paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevec import storage
from lakevec.functions import distance, vectors
from lakevec.operators import topk, zipjoin
from lakevec.operators.asof import asof_join
from lakevec.sources import datasource, logs


@pytest.fixture(scope="module")
def three_million(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('zip')}/rows"
    key = F.xxhash64("id")
    spark.range(0, 3_000_000, 1, 24).select(key.alias("k"), (key + 1).alias("a"), (key + 2).alias("b")).write.parquet(path)
    return path


@pytest.mark.parametrize("threshold,partitions", [("10m", "4"), ("-1", "200")])
def test_large_tables_are_zipped_row_by_row(spark, three_million, threshold, partitions):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = zipjoin.with_ordinal(spark.read.parquet(three_million), ["k"], "n")
        both = zipjoin.zip_columns([rows.select("n", c) for c in ("k", "a", "b")], "n")
        plan = both._jdf.queryExecution().toString()
        assert "rangepartitioning" not in plan  # ranges are cut once, when the table is written
        found = both.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n"), F.count_if((F.col("a") != F.col("k") + 1) | (F.col("b") != F.col("k") + 2))).first()
        assert tuple(found) == (3_000_000, 3_000_000, 0, 2_999_999, 0)
        assert rows.where("n % 100000 = 0").orderBy("n").select("k").collect() == rows.where("n % 100000 = 0").orderBy("k").select("k").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rows_that_tie_keep_their_ordinals(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    rows = zipjoin.with_ordinal(df, ["k"])
    both = zipjoin.zip_columns([rows.select("_ordinal", "v"), rows.select("_ordinal", F.col("m")["a"].alias("w"))])
    assert both.where("v <> w").count() == 0 and both.select("_ordinal").distinct().count() == 5000


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_vectors_that_are_not_finite_take_no_part(spark, metric):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [nan, 1.0]), (3, [0.0, 1.0]), (4, [inf, 0.0]), (5, [-inf, 1.0]), (6, None), (7, [1.0]), (8, [None, 1.0])], "id long, vector array<double>")
    one = [r.id for r in topk.top_k(df, [1.0, 0.1], 9, metric).collect()]
    many = [r.id for r in topk.batch_top_k(df, spark.createDataFrame([(1, [1.0, 0.1]), (2, [nan, 1.0])], "id long, vector array<double>"), 9, metric).orderBy("rank").collect()]
    assert one == many == [1, 3]
    with pytest.raises(ValueError, match="1 to 2 components"):
        topk.batch_top_k(df, df.where("id in (1, 7)"), 3, metric)


def test_bits_of_binary_values(spark):
    r = np.random.default_rng(1)
    pairs = [(r.bytes(n), r.bytes(n)) for n in (1, 7, 8, 15, 16, 33) for _ in range(5)] + [(b"\x0f", b"\xff"), (b"", b""), (b"a", b"ab"), (None, b"a")]
    got = [x[0] for x in spark.createDataFrame(pairs, "a binary, b binary").select(distance.hamming_bytes(F.col("a"), F.col("b"))).collect()]
    assert got == [None if a is None or len(a) != len(b) else sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True)) for a, b in pairs]
    df = spark.createDataFrame([(i, bytes(a)) for i, (a, _) in enumerate(pairs) if a is not None and len(a) == 8], "id long, vector binary")
    (first, *_) = topk.top_k(df, bytes(df.first().vector), 3, "HAMMING").collect()
    assert first.score == 0
    packed = spark.createDataFrame([([1.0, -1.0] * 5,), ([],), ([0.5] * 8,)], "v array<double>").select(vectors.sign_bytes(F.col("v"))).collect()
    assert [bytes(p[0]) for p in packed] == [b"\xaa\x80", b"", b"\xff"]


def test_nulls_match_nothing_as_of(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", None), (4, "a", 1), (5, "b", 9)], "id long, k string, t long")
    right = spark.createDataFrame([("a", 5, 1.0), ("a", 5, 3.0), ("a", 5, None), (None, 1, 9.0), ("a", None, 7.0), ("b", 10, 2.0)], "k string, t long, v double")
    assert {r.id: r.v for r in asof_join(left, right, ["k"], "t", ["v"]).collect()} == {1: 3.0, 2: None, 3: None, 4: None, 5: None}


def test_overwritten_logs(spark, tmp_path):
    datasource.register(spark)
    path = str(tmp_path / "log")
    for n in (5, 3):
        spark.range(n).select(F.col("id").alias("val")).coalesce(1).write.format("column_log").option("path", path).mode("overwrite").save()
        assert spark.read.format("column_log").load(path).count() == n
    spark.range(4).select(F.col("id").alias("val")).coalesce(1).write.format("column_log").option("path", path).mode("append").save()
    assert spark.read.format("column_log").load(path).count() == 7


@pytest.mark.parametrize("name", ["x#y", "a?b", "50%25 off", "two words", "a#b?c%d e"])
@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_signs_in_paths(spark, tmp_path, name, scheme):
    folder = f"{scheme}{tmp_path}/{name}"
    storage.put(f"{folder}/one", b"bytes")
    assert (tmp_path / name / "one").read_bytes() == b"bytes" and [p.name for p in tmp_path.iterdir()] == [name]
    system, inner = storage.worker_fs(f"{folder}/one")
    assert system.open_input_stream(inner).read() == b"bytes"
    datasource.register(spark)
    spark.range(3).select(F.col("id").alias("val")).coalesce(1).write.format("column_log").option("path", f"{folder}/log").mode("append").save()
    assert spark.read.format("column_log").load(f"{folder}/log").count() == 3
    if "?" not in name:  # a pattern to Spark
        assert logs.read_meta(spark, f"{folder}/log").first().rows == 3


def test_parts_of_paths():
    assert storage.parts_of("s3a://bucket/a#b/c?d") == ("s3a", "bucket", "/a#b/c?d")
    assert storage.without_bucket("gs://b/x y#z") == "x y#z" and storage.without_bucket("/plain/p") == "plain/p"
    assert [storage.scheme_of(p) for p in ("/a", "a/b:c", "file:/x", "hdfs://h:8020/x")] == ["file", "file", "file", "hdfs"]


def test_vectors_of_many_lengths_are_encoded_at_once():
    import pyarrow as pa

    values = pa.array([[1.5, -2.0], None, [], [0.25], [None, 3.0]], pa.list_(pa.float32()))
    for part in (values, values.slice(1), values.slice(3, 1), values.slice(0, 0)):
        got = vectors._encoded(part, lambda x: x.astype("<f4")).to_pylist()
        want = [None if v is None else np.array([np.nan if x is None else x for x in v], "<f4").tobytes() for v in part.to_pylist()]
        assert got == want
    assert vectors._encoded(values.slice(0, 1), vectors.to_half).to_pylist() == [np.array([1.5, -2.0], "<f2").tobytes()]
