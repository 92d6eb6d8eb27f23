"""Vector codes against SQL and a plain version."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA

pytest.importorskip("lakevec.llm")
from lakevec.llm import vectorcodes  # noqa: E402


def plain(rows):
    """By loops over parts and entries alone; rows are (vec_id, vector, label) that take part."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    x = np.floor(np.array([r[1] for r in rows], float) * 256).astype(int)
    parts = x.reshape(len(x), 16, -1)
    books = parts[:64].transpose(1, 0, 2).copy()

    def near(p):
        d = ((parts[:, p, None, :] - books[p][None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(2):
        for p in range(16):
            at = near(p)[0]
            for e in range(len(books[p])):
                if (at == e).any():
                    books[p, e] = parts[at == e, p].sum(0) // (at == e).sum()
    found = [near(p) for p in range(16)]
    error = sum(f[1] for f in found)
    by = {}
    for r, e in zip(rows, error, strict=True):
        by[r[2]] = by.get(r[2], 0) + int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return [(r[0], "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), by[r[2]], sha) for i, r in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, oracle, scale):
    got = vectorcodes.compress_table(spark.read.parquet(f"{DATA}/{scale}/embeddings.parquet"))
    columns, want = oracle(vectorcodes.ORACLE_SQL, scale)
    assert ordered(got.select(columns).collect()) == ordered(want)


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    good = [(int(i), [float(v) for v in r.normal(size=32) * r.choice([0.01, 1, 100])], [None, "a", "b"][i % 3]) for i in r.permutation(150)]
    good += [(7, good[0][1], "a"), (7, good[0][1], "a"), (None, good[1][1], None), (3, [0.0] * 32, "a"), (4, [-1 / 256] * 32, "b")]
    odd = [(1, None, "a"), (2, [nan] * 32, "a"), (3, [1.0] * 31 + [None], "a"), (4, [inf] * 32, None), (5, [1.0] * 16, "b"), (6, [], "b")]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>, label string").withColumns({"code": F.lit("clash"), "x": F.lit(1), "v": F.lit(2), "error": F.lit(3)})
    for parts in (1, 9):
        assert ordered(vectorcodes.compress_table(df.repartition(parts)).collect()) == ordered(plain(good))
    few = df.where("vec_id in (10, 11, 12)")
    assert ordered(vectorcodes.compress_table(few).collect()) == ordered(plain([g for g in good if g[0] in (10, 11, 12)]))
    assert vectorcodes.compress_table(df.limit(0)).count() == 0
    assert vectorcodes.compress_table(df.where("embedding IS NULL")).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError, match="equal parts"):
        vectorcodes.compress_table(spark.createDataFrame([(1, [1.0] * 17, "a")], "vec_id long, embedding array<double>, label string"))


@pytest.mark.parametrize("spread", [3, 10**6])
def test_dictionaries_give_the_distances(spread):
    """Dense dictionaries (few values) and sorted ones (many far apart)."""
    r = np.random.default_rng(spread)
    x, books = r.integers(-spread, spread, (500, 32)), r.integers(-spread, spread, (16, 64, 2))
    codes, errors = vectorcodes.nearest(x, books)
    d = ((x.reshape(500, 16, 1, 2) - books[None]) ** 2).sum(3)
    assert (codes == d.argmin(2)).all() and (errors == d.min(2)).all()
    words = vectorcodes.Dictionary(x[:, 0])
    assert (words.values[words.codes] == x[:, 0]).all() and len(set(words.values)) == len(words.values)


def test_codes_decode_to_their_entries(spark):
    df = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet")
    rows, dim = vectorcodes.components(df, "vec_id", "embedding", "label")
    books = vectorcodes.train(rows, dim)
    back = vectorcodes.decode(vectorcodes.encode(rows, books), books)
    both = back.join(df.select("vec_id", "embedding"), "vec_id").collect()
    assert len(both) == df.count()
    for b in both[:50]:
        whole = np.floor(np.array(b.embedding, float) * 256)
        assert ((whole - np.floor(np.array(b.vector, float) * 256)) ** 2).sum() == b.error
