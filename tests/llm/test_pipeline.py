"""The pipeline's stages, each against what its operator says of its input, and the whole run."""

from collections import defaultdict

import pytest

from tests.conftest import DATA

pytest.importorskip("lakevec.llm")
import corpus_pipeline  # noqa: E402
from lakevec.llm import common, exact_dedup, jaccard, packing, secrets, toxicity  # noqa: E402


def test_stages(spark):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    columns, ids = docs.columns, lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.materialise(stage(spark, docs, sf), name)
        if name == "packing":
            assert set(ids(docs)) == set(ids(before))
            lengths = defaultdict(int)
            for r in docs.collect():
                lengths[r.sequence_id] += r.length
            assert max(lengths.values()) <= packing.CAPACITY
            break
        assert docs.columns == columns
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.score_documents(before, toxicity.fit(before, labels)).where("predicted = 1").collect()}
            assert ids(docs) == sorted(set(ids(before)) - bad)
        elif name == "exact_dedup":
            assert ids(docs) == sorted(r.doc_id for r in exact_dedup.group_equal_texts(before).where("kept").collect())
        elif name == "ngram_jaccard":
            assert ids(docs) == sorted({r.component_id for r in jaccard.link_documents(before).collect()})
        else:
            assert ids(docs) == ids(before)
            assert secrets.digest_secrets(docs, secrets.Scanner(None)).where("n_access + n_hex > 0").count() == 0
            clean = {r.doc_id for r in secrets.digest_secrets(before, secrets.fit(before)).where("spans = ''").collect()}
            texts = {r.doc_id: r.text for r in before.collect()}
            assert all(r.text == texts[r.doc_id] for r in docs.collect() if r.doc_id in clean)


def test_run(spark):
    out = corpus_pipeline.run(spark, f"{DATA}/sf0.001")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_odd_documents(spark, tmp_path):
    """Nulls, empty texts, repeats, clashing columns, and no rows at all."""
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, "a b c d e f", "en"), (1, "a b c d e f", "en"), (2, None, None), (3, "", "x"), (None, "a b c d e f", "en"), (4, "w " * 20000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string").withColumnRenamed("_key", "_label")
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            df = common.materialise(stage(spark, df, str(tmp_path)), name)
        assert df.count() >= 0
