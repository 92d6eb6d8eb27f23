"""Every text operator on tables of one short text, in one and in many partitions, and what whole corpora hide."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.test_text_operators import components, shingles

llm = pytest.importorskip("lakevec.llm")
from lakevec.llm import common, exact_dedup, html, jaccard, linededup, packing, pieces, secrets, sharding, toxicity  # noqa: E402

TEXTS = [None, "", "a", "ok", "abc", "abcd", "abcde", "abcdef", "abcdefg", "abcdefgh", "a b", "a b c", "a b c d", "a b c d e", "a b c d e f", ".", "\n", "İ.", "クラ"]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, "you fool idiot" if i % 2 else "a fine day") for i in range(60)], "doc_id long, text string")
    return toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic"))


@pytest.mark.parametrize("parts", [1, 40])
def test_texts_of_few_characters(spark, model, parts):
    all_ = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(parts)
    assert {r.doc_id: r.n_shingles for r in jaccard.link_documents(all_).collect()} == {i: len(shingles(t)) for i, t in enumerate(TEXTS)}
    assert toxicity.score_documents(all_, model).count() == len(TEXTS)
    assert {r.doc_id: r.length for r in packing.pack_documents(all_).collect()}[1] == 1
    for run in (exact_dedup.group_equal_texts, sharding.shard_documents, linededup.dedup_lines, pieces.tokenize, lambda d: secrets.find_secrets(d, secrets.Scanner(None))):
        assert run(all_).count() == len(TEXTS)


def test_texts_alone(spark, model):
    for t in TEXTS:
        one = spark.createDataFrame([(1, t)], "doc_id long, text string").repartition(2)
        assert 0 <= toxicity.score_documents(one, model).first().score <= 1
    for t in ["", "one", "one two", "one two three", "one two three four five six"]:
        one = spark.createDataFrame([(1, t)], "doc_id long, text string")
        assert tuple(jaccard.link_documents(one).first()) == (1, len(shingles(t)), 1)
    assert html.render("a") == "a"


def test_tokens_of_words_before_signs():
    """Letters before any signs, against the tokenizer; a word that is known isn't encoded again for other signs."""
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(packing.tokenizer_path())
    encode, r = packing.word_encoder(packing.tokenizer_path()), random.Random(3)
    signs = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
    letters = [chr(c) for c in range(65, 768) if chr(c).isalpha()]
    chunks = ["don't,", "'s", "x's'", "<|pad|>", "a<|", "µ###", "ªº!", "ß$$$", "İ&&&", "Σ;"]
    chunks += ["".join(r.choices(letters, k=r.randint(0, 9))) + "".join(r.choices(signs, k=r.randint(0, 4))) for _ in range(20_000)]
    got = encode(chunks)
    for chunk, ids, want in zip(chunks, got, tokenizer.encode_batch(chunks, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, ascii(chunk)
    assert encode(["word###", "Word!", "été,"], {"word": b"abcd", "été": b"efgh"}) == [b"abcd" + encode(["###"])[0], b"abcd" + encode(["!"])[0], b"efgh" + encode([","])[0]]


def test_tokens_of_marks_and_signs():
    """Words of many scripts with combining marks before signs, against the tokenizer itself."""
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(packing.tokenizer_path())
    encode, r = packing.word_encoder(packing.tokenizer_path()), random.Random(1)
    scripts = [(0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250), (0x300, 0x370), (0x370, 0x400), (0x400, 0x530), (0x590, 0x600), (0x600, 0x700), (0x900, 0x980), (0xE00, 0xE80)]
    scripts += [(0x1100, 0x1200), (0x1E00, 0x2000), (0x3040, 0x3100), (0x4E00, 0x4F00), (0xAC00, 0xAD00), (0xFB00, 0xFB50), (0x1F600, 0x1F640), (0x2000, 0x2070), (0x30, 0x3A), (0x10400, 0x10450)]
    texts = ["İ.", "ABİ,", "क़.", "שׁ,"]
    for _ in range(20_000):
        one = r.choice(scripts)
        word = "".join(chr(r.randrange(*(one if r.random() < 0.7 else r.choice(scripts)))) for _ in range(r.randint(1, 6)))
        texts.append(" ".join(word[: r.randint(1, len(word))] + r.choice(["", ".", ",", "..", ".,", "\n", " ", "'s"]) for _ in range(r.randint(1, 3))))
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        got = b"".join(encode(packing.split_words(text)))
        assert np.frombuffer(got, "<u4").tolist() == want.ids, ascii(text)


def test_ids_in_several_rows_are_one_document(spark):
    x, y = "a b c d e f g h i", "k l m n o p q r s"
    docs = spark.createDataFrame([(2, x), (15, x), (15, y), (20, y), (15, ""), (30, "zz")], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.link_documents(docs).collect()))
    assert got == [(2, 5, 2), (15, 0, 2), (15, 5, 2), (15, 5, 2), (20, 5, 2), (30, 1, 30)]


@pytest.mark.parametrize("block", [1000, 20])
def test_links_of_the_corpus(spark, block):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    got = {r.doc_id: r.component_id for r in jaccard.link_documents(docs, block=block).collect()}
    assert got == components([(r.doc_id, shingles(r.text)) for r in docs.collect()])


def test_links_at_the_threshold_are_never_lost(spark):
    """Pairs that share exactly three quarters of their shingles, and pairs that just don't."""
    rows = []
    for k in range(60):
        w = [f"w{k}x{i}" for i in range(18)]
        rows += [(4 * k, " ".join(w[:16])), (4 * k + 1, " ".join(w[2:18] if k % 2 else w[1:18]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link_documents(docs).collect()}
    want = components([(i, shingles(t)) for i, t in rows])
    assert got == want and len(set(want.values())) == 90


def log_likelihoods(word, words, counts):
    """Both classes' log-likelihoods of a word by dictionaries alone, and what all next characters' probabilities add up to."""
    marked = [chr(toxicity.START) + w + chr(toxicity.END) for w in words]
    grams = [None] + [Counter(x[1:] for x in {m[i - k : i + 1] for m in marked for i in range(k, len(m))}) for k in range(1, toxicity.ORDER)]
    size = max(2, len(grams[1]) + 1)

    def shared(context, c):
        p = 1 / size
        for k in range(1, min(toxicity.ORDER - 1, len(context) + 1) + 1):
            of = {g: n for g, n in grams[k].items() if g[:-1] == context[len(context) - k + 1 :]}
            if of:
                p = (max(of.get(context[len(context) - k + 1 :] + c, 0) - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * len(of) * p) / sum(of.values())
        return p

    def next_(before, c, count):
        k = min(len(before) + 1, toxicity.ORDER)
        seen = Counter()
        for m, n in zip(marked, count, strict=True):
            for i in range(1, len(m)):
                if min(i + 1, toxicity.ORDER) == k and m[i - k + 1 : i] == before[-(k - 1) :]:
                    seen[m[i]] += n
        kinds = sum(n > 0 for n in seen.values())
        weight = toxicity.STRENGTH + toxicity.DISCOUNT * kinds
        return (max(seen[c] - toxicity.DISCOUNT, 0) + weight * shared(before[-(k - 1) :][1:], c)) / (sum(seen.values()) + toxicity.STRENGTH)

    whole = chr(toxicity.START) + word + chr(toxicity.END)
    every = sorted({c for m in marked for c in m[1:]}) + ["￿"]
    sums = [sum(next_(whole[:i], c, n) for c in every) for n in counts for i in range(1, len(whole))]
    return [sum(math.log(next_(whole[:i], whole[i], n)) for i in range(1, len(whole))) for n in counts], sums


def test_models_are_distributions():
    words, counts = ["idiot", "idiom", "clown", "a", "an", "down"], ([0, 3, 1, 5, 2, 4], [4, 1, 3, 1, 0, 0])
    model = toxicity.KneserNey(words, *map(np.array, counts))
    for w in [*words, "idiots", "xyz", "clowndown", ""]:
        (ordinary, toxic), sums = log_likelihoods(w, words, counts)
        assert np.allclose(sums, 1)
        assert abs(toxic - ordinary - model.evidence([w])[0]) < 1e-9


def test_every_labelled_row_counts(spark):
    """A word that only labelled rows beyond the 3,000 of smallest hash hold, and whole counts after frequent contexts."""
    n = 6_000
    rows = spark.range(2 * n).withColumn("toxic", (F.col("id") % 2).cast("int"))
    rows = rows.withColumn("_fold", toxicity.fold(F.col("id"))).withColumn("r", F.expr("row_number() OVER (PARTITION BY toxic, _fold NOT IN (0, 4) ORDER BY xxhash64(id, 'toxicity'), id)"))
    rare = F.when((F.col("r") > 3_000) & (F.col("toxic") == 1), F.lit(" zorgblat")).otherwise(F.lit(""))
    rows = rows.select(F.col("id").alias("doc_id"), "toxic", "_fold", "r", F.concat(F.lit("plain words number "), F.col("id").cast("string"), rare).alias("text"))
    rows = common.materialise(rows, "rows")
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    counted = rows.where("_fold IN (1, 2, 3)")
    assert counted.where("text LIKE '%zorgblat%'").count() > 0
    assert model.counts.evidence(["zorgblat"])[0] > 1 > abs(model.counts.evidence(["plain"])[0])
    key = toxicity.string_keys([chr(toxicity.START) + "z"])
    assert model.counts.top[1](key)[1][0] == counted.where("text LIKE '%zorgblat%'").count()


def test_grams_of_words(spark):
    words, counts = ["idiot", "idiom", "clown", "a", "an", "downtowners"], ([0, 3, 1, 5, 2, 4], [4, 1, 3, 1, 0, 0])
    df = spark.createDataFrame(list(zip(words, *counts, strict=True)), "word string, n0 long, n1 long")
    found = toxicity.frequent_grams(df)
    columns = [found.column(c).to_numpy() for c in ("n0", "n1")]
    kinds = toxicity.kinds_of(words)
    model = toxicity.KneserNey(words, *map(np.array, counts))
    same = toxicity.KneserNey.of_grams(found.column("gram").to_pylist(), *columns, (kinds.k, kinds.key, kinds.context, np.ones(len(kinds.k))))
    asked = [*words, "idiots", "xyz", "clowndown", ""]
    assert np.allclose(model.evidence(asked), same.evidence(asked))
    few = toxicity.frequent_grams(df, 10).to_pylist()  # after contexts that are a tenth of either class's places, or more
    assert {g["gram"]: (g["n0"], g["n1"]) for g in few} == {g["gram"]: (g["n0"], g["n1"]) for g in found.to_pylist() if g["gram"] in {x["gram"] for x in few}}
    assert 0 < len(few) < found.num_rows
    contexts = toxicity.Contexts.within(sorted({g[:-1] for g in found.column("gram").to_pylist()}))
    of_kinds = toxicity.Contexts.of(kinds)
    for k in range(1, toxicity.ORDER):
        assert set(contexts.tables[k].keys.tolist()) <= set(of_kinds.tables[k].keys.tolist())
        at, hit = of_kinds.tables[k].find(contexts.tables[k].keys)
        assert hit.all() and (of_kinds.shifted[k][at] == contexts.shifted[k]).all()


def test_shared_counts_are_those_of_all_documents(spark):
    """Kinds in the distinct words of the whole table, restricted to the sample's contexts, against plain sets."""
    texts = ["idiot idiom", "the clown", "a clownish idiotic thing", None, "idiom " * 50]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    own = toxicity.kinds_of(["idiot", "clown"])
    among = [set(own.context[own.k == k].tolist()) for k in range(toxicity.ORDER)]
    k, key, context, n = toxicity.shared_kinds(docs, toxicity.Contexts.of(own))
    every = toxicity.kinds_of(sorted({w for t in texts for w in toxicity.words_of(t)}))
    want = Counter((int(a), int(b), int(c)) for a, b, c in zip(every.k, every.key, every.context, strict=True) if c in among[a])
    assert {(int(a), int(b), int(c)): int(m) for a, b, c, m in zip(k, key, context, n, strict=True)} == want


def test_hashes_of_lines_and_texts(spark):
    """Digest columns of one-line texts, by hand."""
    docs = spark.createDataFrame([(1, "one line of text"), (2, "One line of text\nmore")], "doc_id long, text string")
    got = {r.doc_id: r.kept_sha256 for r in linededup.dedup_lines(docs, digest=True).collect()}
    assert got == {1: hashlib.sha256(b"one line of text").hexdigest(), 2: hashlib.sha256(b"more").hexdigest()}
    assert re.fullmatch("[0-9a-f]{64}", got[1])
