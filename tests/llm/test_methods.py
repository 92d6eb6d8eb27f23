"""Methods against independent versions: merge rounds, content sort, style rules, graphs in many shards, weighted draws."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA

llm = pytest.importorskip("lakevec.llm")
from lakevec.llm import exact_dedup, hnsw, html, pieces, secrets, sharding  # noqa: E402


def test_rounds_give_the_library_ids():
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.model_path())
    v, r = pieces.Vocabulary(pieces.model_path()), random.Random(2)
    words = "the of and to in that is was for on are with they this from have which their said would about people water called where most know".split()
    pool = [*"abcdefghijklmnopqrstuvwxyz   \n\t.,'▁éüñ日本語のテキスト🎉0123456789-_/=<>"]
    makes = [lambda: "".join(r.choice(pool) for _ in range(r.randint(0, 60))), lambda: "".join(r.choice(words) for _ in range(r.randint(1, 80)))]
    makes += [lambda: " ".join(r.choice(words) for _ in range(r.randint(1, 30))), lambda: r.choice("abxyz=-_. ") * r.randint(1, 400), lambda: "".join(r.choice("ab") for _ in range(r.randint(1, 300)))]
    texts = [r.choice(makes)() for _ in range(2000)]
    texts += ["x" * 50_000, "".join(r.choice(words) for _ in range(9000)), "日本語テキスト" * 5000, "".join(r.choice("abcdefghij0123456789") for _ in range(40_000))]
    for t in texts:
        assert pieces.encode(t, v) == sp.encode(t), t[:80]


@pytest.mark.parametrize("rounds", [0, 3])
def test_what_rounds_leave_is_merged_alike(monkeypatch, rounds):
    v = pieces.Vocabulary(pieces.model_path())
    texts = ["thethatwhichwould" * 9, "an ordinary line of text", "日本語テキスト", ""]
    want = [pieces.encode(t, v) for t in texts]
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    assert [pieces.encode(t, v) for t in texts] == want


@pytest.mark.parametrize("ranges", [1, 60])
def test_groups_that_splitters_cut(spark, monkeypatch, ranges):
    """Copies in many ranges, ids and whole rows repeated: one row of each text stays, the same at every run."""
    monkeypatch.setattr(exact_dedup, "RANGES_PER_PARTITION", ranges)
    r = random.Random(6)
    texts = ["one text that a third of all rows have", "one  text that a third of all rows have", "a text", None, "", " ", *(f"text {k}" for k in range(40))]
    rows = [(r.choice([None, *range(90)]), texts[0] if r.random() < 0.3 else r.choice(texts), k % 3, f"s{k % 5}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int, _norm string")
    squeeze = lambda t: " ".join(["", *t.split(), ""]).strip() if t and t.strip() else (" " if t else "")
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[squeeze(t)].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = exact_dedup.group_equal_texts(docs).collect()
    assert sum(x.kept for x in got) == len(groups)
    assert sorted((x.group_size, str(x.keep_id)) for x in got) == sorted((len(groups[squeeze(t)]), str(least[squeeze(t)])) for _, t, *_ in rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.schema == docs.schema
    first = sorted(map(str, kept.collect()))
    assert sorted((squeeze(x.text), str(x.doc_id)) for x in kept.collect()) == sorted((t, str(i)) for t, i in least.items())
    assert first == sorted(map(str, exact_dedup.drop_copies(docs.repartition(7)).collect()))

def test_splitters_follow_the_bytes_of_whole_texts(spark):
    """Texts that begin alike for 500 characters are told apart, ranges are even, and a frequent text has its own."""
    texts = ["q" * 500 + f"{i * 7919 % 3000:05}" for i in range(3000)] + ["q" * 499 + "é"] * 1500 + ["ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "_id long, _text string").repartition(5)
    cuts, own = exact_dedup._splitters(docs, 16, len(texts))
    assert cuts == sorted(cuts) and max(map(len, cuts)) <= 505 and len(own) == 1 and own[0][2] > 1
    rows = exact_dedup._dealt(docs, F.col("_text"), cuts, own).select("_text", "_range", "_cut").collect()
    sizes = {}
    for r in rows:
        sizes[r["_range"]] = sizes.get(r["_range"], 0) + 1
        assert r["_cut"] == r["_text"].endswith("é")
    assert max(sizes.values()) < 3 * len(texts) / 16 and len(sizes) > 10
    plain = sorted((r["_text"], r["_range"]) for r in rows if not r["_cut"])
    assert [x for _, x in plain] == sorted(x for _, x in plain)
    assert exact_dedup._splitters(docs.limit(0), 16, 0) == ([], [])


@pytest.mark.parametrize("a,b,n", [("", "", 0), ("abc", "abd", 2), ("abc", "abcd", 3), ("éx", "éy", 1), ("x" * 5000, "x" * 4999 + "y", 4999), ("a", "b", 0)])
def test_shared_beginnings(spark, a, b, n):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(exact_dedup._shared(F.col("a"), F.col("b"))).first()[0] == n


@pytest.mark.parametrize("n", [0, 1, 12, 47, 48, 49, 56, 57, 88, 89, 5000])
def test_views_cover_whole_candidates(n):
    text = "x" * 30 + "".join(chr(0x4E00 + i) for i in range(n)) + " after it all"
    views = secrets.views(text, 30, 30 + n)
    seen, at = set(), 30
    for before, body, after in views[1:] or views:
        at = text.index(body, at) if n > 48 else 30
        assert before == "x" * secrets.BEFORE and after == " after i" and len(body) == min(n, secrets.INSIDE)
        seen |= set(range(at, at + len(body)))
    assert seen == set(range(30, 30 + n))


def test_a_secret_late_in_a_long_candidate_counts():
    class Marks:
        """Stands for a network that knows one sign."""

        def logits(self, x):
            return np.where((x == ord("Z") + 2).any(1), 9.0, -9.0)

    text = "see " + "x1" * 400 + "Z" + "y2" * 300 + " and " + "w3" * 90
    spans = secrets.scan([text, None, ""], secrets.Scanner(Marks(), threshold=0.5))
    assert [[(a, b, k) for a, b, k, _ in s] for s in spans] == [[(4, 4 + 1401, "net")], [], []]


def test_rules_of_style_sheets():
    page = "<style>.ad p{display:none} nav > span{display:none} #x.y{display:none} * .q{visibility:hidden} .ad p.keep{display:block}</style>"
    page += "<div class=ad><div><p>gone</p><p class=keep>stays</p></div></div><p>seen</p><nav><span>child</span><b><span>deep</span></b></nav>"
    page += "<i id=x class='y z'>both</i><i id=x>one</i><u><b class=q>unseen</b></u>"
    assert html.render(page).split() == ["stays", "seen", "deep", "one"]


def test_depth_and_wide_cells():
    assert html.render("<div>" * 400 + "deep" + "</div>" * 400 + "after") == "deep\nafter"
    assert html.render("<b>" * 5000 + "x") == "x"
    wide = "w" * 90
    lines = html.render(f"<table><tr><td>{wide}<td>b</table>").split("\n") + html.render(f"<table><tr><td>{wide}<td>b<tr><td>a<td>c</table>").split("\n")
    assert lines[1:] == [wide + "  b", "a" + " " * 91 + "c"]


def test_shards_follow_from_the_data():
    assert hnsw.shards_for(0, 64) == 1 == hnsw.shards_for(4096, 64)
    assert hnsw.shards_for(51_000, 64) == 6 and hnsw.shards_for(10**9, 64) == -(-(10**9) // ((64 << 20) // 512))


@pytest.mark.parametrize("blocks", [1 << 25, 9000])
def test_recall_over_many_shards(spark, blocks):
    rows, dim = hnsw.usable(spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet"), "vec_id", "embedding")
    index, shards = hnsw.build_index(rows, dim, most_bytes=250 * 8 * dim)
    assert shards >= 8
    queries = rows.where("vec_id % 20 = 0")
    found = defaultdict(list)
    for x in hnsw.search_index(index, shards, queries, dim, 20, most_bytes=blocks).orderBy("query_id", "rank").collect():
        found[x.query_id].append(x.vec_id)
    all_ = rows.collect()
    ids, m = np.array([x.vec_id for x in all_]), np.array([x.vector for x in all_])
    hits = 0
    for q in found:
        s = m @ m[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -s))[:20]].tolist()) & set(found[q]))
    assert len(found) == queries.count() and hits / (20 * len(found)) > 0.99


def test_draws_row_by_row(spark):
    """Every row's path down the tree by plain Python over the same hashes."""
    leaves = [x._replace(weight=1 + x.shard / 4) for x in sharding.topology(8)]
    names = [("region", {x.region for x in leaves}), ("rack", {x.rack for x in leaves}), ("shard", {x.shard for x in leaves})]
    hashes = [F.xxhash64("k", F.lit(f"{level}:{n}")).alias(f"{level}{n}") for level, of in names for n in sorted(of)]
    keys = spark.range(500).withColumnRenamed("id", "k")
    grown = sharding.place(sharding.place(keys, ["k"], leaves), ["k"], sharding.grown(leaves), "new_")
    got = {r.k: r for r in grown.collect()}
    tree = {r.k: r for r in keys.select("k", *hashes).collect()}
    weight = defaultdict(float)
    for x in leaves:
        for level in ("region", "rack", "shard"):
            weight[level, getattr(x, level)] += x.weight
    for k, r in got.items():
        path = {}
        for level in ("region", "rack", "shard"):
            inside = {getattr(x, level) for x in leaves if all(getattr(x, up) == n for up, n in path.items())}
            draw = lambda n: -math.log(((tree[k][f"{level}{n}"] % 2**64 >> 11) + 0.5) / 2**53) / weight[level, n]  # noqa: B023, E731
            path[level] = min(inside, key=draw)
        assert (r.region, r.rack, r.shard) == (path["region"], path["rack"], path["shard"])
        assert r.new_shard in (r.shard, 8)
