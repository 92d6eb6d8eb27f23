"""Benchmark phrases against SQL and a plain search; the index against its text."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA

pytest.importorskip("lakevec.llm")
from lakevec.llm import decontaminate, fmindex  # noqa: E402


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = [(i, tuple(w[a : a + 10])) for i, t in items if (w := words(t)) for a in range(max(1, len(w) - 9))]
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, p in windows:
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a : a + len(p)]) == p:
                    hit |= set(range(a, a + len(p)))
                    ids.add(item)
        ids = sorted(map(str, ids - {None}))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, oracle, scale):
    docs, items = (spark.read.parquet(f"{DATA}/{scale}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontaminate.digest(decontaminate.find_benchmark(docs, items))
    columns, want = oracle(decontaminate.ORACLE_SQL, scale)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want)


@pytest.mark.parametrize("seed", range(20))
def test_index_finds_every_occurrence(seed):
    r = np.random.default_rng(seed)
    texts = [list(r.integers(1, 4, r.integers(0, 40))) for _ in range(r.integers(1, 9))]
    texts += texts[: r.integers(0, 4)] + [[1] * 70] * (seed % 2)
    text = np.concatenate([[*t, 0] for t in texts]).astype(np.int32)
    order = fmindex.suffix_order(text)
    ends = np.flatnonzero(text == 0)
    suffix = lambda i: (tuple(text[i : ends[np.searchsorted(ends, i)]]) + (0,), i if text[i] == 0 else 0)
    assert sorted(order.tolist()) == list(range(len(text)))
    keys = [suffix(i)[0] for i in order if text[i]]
    assert keys == sorted(keys)
    index = fmindex.FMIndex.of_state(fmindex.FMIndex.build(text, 4).state())
    patterns = [list(r.integers(1, 4, r.integers(1, 7))) for _ in range(30)]
    matrix, lengths = np.array([p + [-1] * (7 - len(p)) for p in patterns]), np.array([len(p) for p in patterns])
    got = {(int(a), int(b)) for w, at in index.occurrences(matrix, lengths) for a, b in zip(w, at, strict=True)}
    assert got == {(i, a) for i, p in enumerate(patterns) for a in range(len(text)) if text[a : a + len(p)].tolist() == p}
    low, high = index.search(matrix, lengths)
    assert [int(n) for n in high - low] == [sum(w == i for w, _ in got) for i in range(len(patterns))]


def test_locating_in_portions(monkeypatch):
    monkeypatch.setattr(fmindex, "LOCATED", 5)
    text = np.array([1, 2] * 30 + [0], np.int32)
    found = list(fmindex.FMIndex.build(text, 3).occurrences(np.array([[1, 2], [2, 1], [2, 2]]), np.array([2, 2, 2])))
    assert len(found) > 1 and sorted(np.concatenate([at for _, at in found]).tolist()) == list(range(59))


CASES = [(1, None), (2, ""), (3, "..!"), (4, "the Quick brown fox"), (5, "A quick; brown-FOX jumps over the lazy dog and runs far away again"), (6, "É É é quick"), (7, "x " * 30), (None, "a quick brown fox"), (4, "one two"), (8, "fox")]
ITEMS = [(1, "quick brown fox"), (2, None), (3, "..."), (4, "quick brown fox jumps over the lazy dog and runs far away"), (10, "x x x x x x x x x x x x"), (4, "two"), (None, "one"), (2, "É"), (12, "fox"), (5, "nowhere at all")]


@pytest.mark.parametrize("block,shard", [(1 << 20, 1 << 20), (10, 8)])
def test_odd_texts(spark, block, shard):
    docs = spark.createDataFrame(CASES * 2 + [(90 + i, "a b quick brown fox " * 400 * i) for i in range(3)], "doc_id long, text string").withColumns({"shard": F.lit("clash"), "spans": F.lit(1), "words": F.lit(2)})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("lengths", F.lit(1))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for parts in (1, 6):
        got = decontaminate.digest(decontaminate.find_benchmark(docs.repartition(parts), items, block, shard))
        assert sorted(map(tuple, got.collect()), key=str) == plain(rows, ITEMS)
    found = decontaminate.find_benchmark(docs, items, block, shard)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found.where("doc_id in (5, 7)").collect()}
    assert spans == {5: [(1, 13)], 7: [(0, 30)]}
    assert decontaminate.find_benchmark(docs.limit(0), items).count() == 0
    nothing = decontaminate.digest(decontaminate.find_benchmark(docs, items.limit(0)))
    assert nothing.count() == len(rows) and not nothing.where("contaminated").count()


def test_removal_cuts_what_was_found(spark):
    docs = spark.createDataFrame([*CASES, (5, CASES[4][1])], "doc_id long, text string").withColumn("lang", F.lit("en"))
    items = spark.createDataFrame([(4, ITEMS[3][1]), (2, "É")], "item_id long, text string")
    left = decontaminate.remove(docs, decontaminate.find_benchmark(docs, items))
    assert left.columns == docs.columns and left.count() == 11
    got = {(r.doc_id, r.text) for r in left.collect()}
    assert {t for i, t in got if i == 5} == {"A  again"}
    assert {(1, None), (6, " é quick"), (8, "fox")} <= got
    again = decontaminate.find_benchmark(left, items)
    assert not again.where(F.size("spans") > 0).where("doc_id = 5").count()
