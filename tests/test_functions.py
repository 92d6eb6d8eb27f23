import base64

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevec.functions import distance, hashing, jsonfn, vectors

# fixed values: hashes of the powers of ten and of 0
HASHES = {
    0: 1669671676, 1: 1392991556, 10: 1857498428, 100: 1177227376, 10**3: 679959820, 10**4: 1785225994, 10**5: 258819970, 10**6: 1669527334,
    10**7: 112035536, 10**8: 107125476, 10**9: 913068403, 10**10: 1151135, 10**11: 2136277055, 10**12: 636570700, 10**13: 469485073,
    10**14: 745519692, 10**15: 1724407835, 10**16: 2022854314, 10**17: 1713940411, 10**18: 2117120843,
}


def test_int64_hash(spark):
    rows = spark.createDataFrame([(k,) for k in HASHES], "k long").select("k", hashing.hash_int64(F.col("k")).alias("h")).collect()
    assert {r.k: r.h for r in rows} == HASHES
    assert spark.sql("SELECT cast(null AS bigint) AS k").select(hashing.hash_int64(F.col("k"))).first()[0] is None


def test_string_hash(spark):
    df = spark.createDataFrame([("ok",), ("abcdef",), ("x" * 100,), ("x" * 200,)], "s string").select(hashing.hash_string(F.col("s")).alias("h"))
    h = [r.h for r in df.collect()]
    assert h[:2] == [2044517703, 1267612143] and h[2] == h[3]


def test_vector_codecs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 8)).astype(np.float32)
    x[0, :4] = [0, np.inf, -np.inf, 1e-42]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "id long, v array<float>")
    for write, read, kind in ((vectors.floats_to_le, vectors.floats_from_le, "<f4"), (vectors.floats_to_be, vectors.floats_from_be, ">f4"), (vectors.floats_to_half, vectors.floats_from_half, "<f2")):
        got = df.select("id", write("v").alias("b"), read(write("v")).alias("v")).orderBy("id").collect()
        assert got[-1].b is None and got[-1].v is None
        with np.errstate(over="ignore"):
            for r in got[:-1]:
                assert r.b == x[r.id].astype(kind).tobytes()
                np.testing.assert_array_equal(np.array(r.v, np.float32), x[r.id].astype(kind).astype(np.float32))


def test_bfloat_and_truncation(spark):
    x = np.array([1.0, 0.123455, -3.1415927, np.nan, np.inf], np.float32)
    assert vectors._bfloat(np.frombuffer(vectors.to_bfloat(x).tobytes(), np.uint8)).tolist()[:1] == [1.0]
    assert abs(vectors._bfloat(np.frombuffer(vectors.to_bfloat(x).tobytes(), np.uint8))[1] - 0.123455) < 0.0005
    assert vectors.to_half_truncated(np.array([0.123455], np.float32)).tobytes().hex() == "2fe6"
    assert vectors.to_half(np.array([0.123455], np.float32)).tobytes().hex() == "e72f"


def test_sparse(spark):
    df = spark.createDataFrame([('{"7": 0.5, "2": 1.5}',), (None,), ("{}",)], "j string").select(vectors.sparse_from_json(F.col("j")).alias("m"))
    rows = df.select("m", vectors.sparse_to_bytes("m").alias("b"), vectors.sparse_from_bytes(vectors.sparse_to_bytes("m")).alias("back")).collect()
    assert list(rows[0].m.items()) == [(2, 1.5), (7, 0.5)] == list(rows[0].back.items())
    assert rows[0].b == np.array([(2, 1.5), (7, 0.5)], [("i", "<u4"), ("v", "<f4")]).tobytes()
    assert rows[1].back is None and rows[2].back == {}


def test_binary_text(spark):
    df = spark.createDataFrame([("P0xnDg==",), ("abcd",)], "t string").select(vectors.packed_bits(F.col("t"), 32).alias("b"))
    assert [bytes(r.b) for r in df.collect()] == [base64.b64decode("P0xnDg=="), b"abcd"]


def test_wrong_length_raises(spark):
    with pytest.raises(Exception, match="multiple of 4"):
        spark.createDataFrame([(b"abc",)], T.StructType([T.StructField("b", T.BinaryType())])).select(vectors.floats_from_le("b")).collect()


def test_distances(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 16))
    r = spark.createDataFrame([(a.tolist(), b.tolist(), bytes([255, 0, 1]), bytes([0, 0, 3]))], "a array<double>, b array<double>, x binary, y binary")
    r = r.select(distance.l2(F.col("a"), F.col("b")), distance.inner_product(F.col("a"), F.col("b")), distance.cosine(F.col("a"), F.col("b")), distance.hamming_bytes(F.col("x"), F.col("y"))).first()
    np.testing.assert_allclose(r[:3], [np.linalg.norm(a - b), a @ b, a @ b / np.linalg.norm(a) / np.linalg.norm(b)])
    assert r[3] == 9
    with pytest.raises(ValueError):
        distance.score("nope", F.col("a"), F.col("b"))


def test_json(spark):
    texts = ['{"pk": 42, "ts": 455257023810633736, "pkType": 5}', '{"pk": "a b"}', "17", "x", None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(jsonfn.delete_record(F.col("t")).alias("d"), jsonfn.parse_key(F.col("t")).alias("k"), jsonfn.valid(F.col("t")).alias("v")).collect()
    assert [(r.d.pk, r.d.ts) for r in rows] == [("42", 455257023810633736), ("a b", None), ("17", None), ("x", None), (None, None), ("", None)]
    assert [r.k.pk for r in rows] == [42, None, 17, None, None, None]
    assert [r.v for r in rows][:5] == [True, True, True, False, None]
