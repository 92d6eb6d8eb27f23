"""The corpus operators as driver queries: ``QUERIES`` and, where SQL can express them, ``ORACLE_SQL``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, hnsw, html, jaccard, linededup, packing, pieces, secrets, sharding, toxicity, turns, vectorcodes
from .common import spread, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=8)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search_table(table(spark, sf_dir, "embeddings"), every=20)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(spread(table(spark, sf_dir, "pages")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spread(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(spread(table(spark, sf_dir, "documents")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(spread(table(spark, sf_dir, "documents")), digest=True)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_equal_texts(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return secrets.digest_secrets(docs, secrets.fit(docs))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_tokens(spread(table(spark, sf_dir, "documents")))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress_table(table(spark, sf_dir, "embeddings"))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_table(table(spark, sf_dir, "conversations"))


def op13_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return decontaminate.digest(decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark")))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_nearest": op2_nearest,
    "op3_html_text": op3_html_text,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_line_dedup": op7_line_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secrets": op9_secrets,
    "op10_pieces": op10_pieces,
    "op11_codes": op11_codes,
    "op12_turns": op12_turns,
    "op13_benchmark": op13_benchmark,
}

ORACLE_SQL = {
    "op7_line_dedup": linededup.ORACLE_SQL,
    "op8_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_codes": vectorcodes.ORACLE_SQL,
    "op12_turns": turns.ORACLE_SQL,
    "op13_benchmark": decontaminate.ORACLE_SQL,
}
