"""Benchmark decontamination: an FM-index for each shard of the training texts, asked for all phrases of the benchmark.

A task takes the texts of its part of the table as they come, shard after shard of about SHARD_WORDS words, so nothing is
shuffled and no text, source or group of copies is special; equal texts of a shard are indexed once. An index is a row of
flat arrays in a table of the shared folder and knows nothing of the benchmark: it can be asked for another one.

Phrases are windows of WINDOW consecutive words of an item. They go to the indexes in blocks of a stated size: backward
search narrows all of a block's windows at once, occurrences are located by sampled positions, and overlapping ones are
merged to removal spans.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .batches import text_slices
from .fmindex import FMIndex

WINDOW = 10
#: Words of a shard; a longer text is a shard of its own. Bytes of items that are asked for at once.
SHARD_WORDS, BLOCK_BYTES = 1 << 20, 4 << 20
#: Words in UTF-8 with lower-case letters: all but these signs of ASCII, so every byte of other characters is in a word.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
INDEX = (
    "doc_ids array<bigint>, texts binary, digests array<binary>, starts binary, vocabulary binary, "
    "fm struct<less: binary, levels: array<binary>, zeros: array<bigint>, marks: binary, wide: boolean, samples: binary>"
)
FOUND = "shard string, row long, doc_id long, n_words long, spans array<struct<start: bigint, end: bigint>>, items array<bigint>, text_sha256 binary"


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, then all words; none for null."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class _Shard:
    """Texts that become one index."""

    def __init__(self):
        self.doc_ids, self.texts, self.known = [], [], {}
        self.words: dict[bytes, int] = {}
        self.digests, self.symbols, self.size = [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        text = text or ""
        if text not in self.known:
            self.known[text] = len(self.known)
            # numbers are given in the order of first occurrence
            words, get = self.words, self.words.setdefault
            self.symbols.append(np.array([get(w, len(words) + 1) for w in words_of(text)] + [0], np.int32))
            self.digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
            self.size += len(self.symbols[-1])
        self.doc_ids.append(doc_id)
        self.texts.append(self.known[text])

    def row(self) -> dict:
        starts = np.r_[0, np.cumsum([len(x) for x in self.symbols])]
        fm = FMIndex.build(np.concatenate(self.symbols), len(self.words) + 1)
        return {
            "doc_ids": self.doc_ids, "texts": np.array(self.texts, "<i4").tobytes(), "digests": self.digests, "starts": starts.astype("<i8").tobytes(),
            "vocabulary": b" ".join(self.words), "fm": fm.state(),
        }


_FM = pa.struct([("less", pa.binary()), ("levels", pa.list_(pa.binary())), ("zeros", pa.list_(pa.int64())), ("marks", pa.binary()), ("wide", pa.bool_()), ("samples", pa.binary())])
_ROW = pa.schema([("doc_ids", pa.list_(pa.int64())), ("texts", pa.binary()), ("digests", pa.list_(pa.binary())), ("starts", pa.binary()), ("vocabulary", pa.binary()), ("fm", _FM)])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row for each shard (INDEX and a name), as a table in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for part in text_slices(batch):
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    shard.add(doc_id, text)
                    if shard.size >= shard_words:
                        yield pa.RecordBatch.from_pylist([shard.row()], _ROW)
                        shard = _Shard()
        if shard.doc_ids:
            yield pa.RecordBatch.from_pylist([shard.row()], _ROW)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, INDEX)
    return common.materialise(rows.withColumn("shard", F.concat_ws("-", F.spark_partition_id(), F.monotonically_increasing_id())), "fm-index")


class Phrases:
    """The windows of some items: rows of word numbers, how many of them count, and the items of each window."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        words, seen, of = {}, {}, []
        for item, text in items:
            numbers = [words.setdefault(w, len(words)) for w in words_of(text)]
            for i in range(max(1, len(numbers) - window + 1) if numbers else 0):
                key = tuple(numbers[i : i + window])
                if key not in seen:
                    seen[key] = len(seen)
                    of.append(set())
                of[seen[key]].add(item)
        self.words = list(words)
        self.lengths = np.array([len(k) for k in seen], np.int64)
        self.windows = np.array([k + (-1,) * (window - len(k)) for k in seen], np.int64).reshape(len(seen), window)
        self.items = [frozenset(x - {None}) for x in of]

    def symbols(self, vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the windows whose words are all in the vocabulary, the windows in its symbols)."""
        place = dict(zip(vocabulary, itertools.count(1), strict=False))
        number = np.array([place.get(w, 0) for w in self.words] + [1], np.int64)  # the last one stands for "no more words"
        symbols = number[self.windows]
        usable = np.flatnonzero((symbols > 0).all(1))
        return usable, symbols[usable]


def _searched(row: dict, phrases: Phrases) -> pa.RecordBatch:
    """What a shard's documents hold of the phrases."""
    starts, texts, fm = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["texts"], "<i4"), FMIndex.of_state(row["fm"])
    usable, patterns = phrases.symbols(row["vocabulary"].split(b" ") if row["vocabulary"] else [])
    lengths = phrases.lengths[usable]
    change, pairs = np.zeros(len(fm) + 1, np.int32), []
    for window, at in fm.occurrences(patterns, lengths):
        np.add.at(change, at, 1)
        np.add.at(change, at + lengths[window], -1)
        pairs.append(np.unique((np.searchsorted(starts, at, "right") - 1) * len(usable) + window))
    covered = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    begin, end = edges[::2], edges[1::2]
    text = np.searchsorted(starts, begin, "right") - 1
    spans, items = {}, {}
    for t, b, e in zip(text.tolist(), (begin - starts[text]).tolist(), (end - starts[text]).tolist(), strict=True):
        spans.setdefault(t, []).append({"start": b, "end": e})
    known: dict[tuple, list[int]] = {}
    pair = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    for t, group in itertools.groupby(pair.tolist(), lambda x: x // len(usable)):
        key = tuple(usable[x % len(usable)] for x in group)
        if key not in known:
            known[key] = sorted(frozenset().union(*(phrases.items[w] for w in key)), key=str)
        items[t] = known[key]
    sizes = np.diff(starts) - 1
    columns = [
        pa.array([row["shard"]] * len(texts), pa.string()), pa.array(np.arange(len(texts))), pa.array(row["doc_ids"], pa.int64()), pa.array(sizes[texts]),
        pa.array([spans.get(t, []) for t in texts.tolist()], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        pa.array([items.get(t, []) for t in texts.tolist()], pa.list_(pa.int64())), pa.array([row["digests"][t] for t in texts.tolist()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "row", "doc_id", "n_words", "spans", "items", "text_sha256"])


def blocks_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", most_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items, (item_id, text), in parts of about ``most_bytes`` of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // most_bytes))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def search_index(index: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """FOUND: for every indexed document its words, the spans of words that occur in the benchmark, and the items."""
    found = None
    for block in blocks:
        table = block.toArrow()  # about BLOCK_BYTES
        shared = index.sparkSession.sparkContext.broadcast(Phrases(list(zip(table.column("item_id").to_pylist(), table.column("text").to_pylist(), strict=True))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _searched(batch.slice(i, 1).to_pylist()[0], shared.value)

        here = index.mapInArrow(run, FOUND)
        if len(blocks) > 1:
            here = common.materialise(here, "found")
            shared.destroy()
        found = here if found is None else found.unionByName(here)
    if len(blocks) == 1:
        return found
    # what several blocks found in a document: spans in order, those that meet become one
    all_ = found.groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.first("text_sha256").alias("text_sha256"),
    )
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    last = lambda done: F.element_at(done, -1)
    put = lambda done, s: F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end"))))).otherwise(F.concat(done, F.array(s)))
    by_text = F.transform(F.array_sort(F.transform("items", lambda x: F.struct(x.cast("string").alias("text"), x.alias("id")))), lambda s: s["id"])
    return all_.withColumns({"spans": F.aggregate("spans", none, put), "items": by_text})


def find_benchmark(docs: DataFrame, benchmark: DataFrame, most_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """FOUND for every row of ``docs`` (doc_id, text) and the items of ``benchmark`` (item_id, text).

    ``spans`` are ranges of the document's words, ``items`` the ids of all items with a window in the text, in the order
    of their text. A null or empty text has no words and no hits; an item of fewer words than a window is one window, one
    without words none. Items that repeat an id are one item; the words of an item without an id are hit, but it isn't
    listed. Rows that repeat a doc_id, or have none, are rows of their own. Texts may have any length. An empty benchmark
    hits nothing; empty documents give an empty result. Other columns are left out, whatever their names.
    """
    return search_index(build_index(docs, shard_words=shard_words), blocks_of(benchmark, most_bytes=most_bytes))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
            if spans:
                data = text.encode("utf-8", "surrogatepass")
                at = [m.span() for m in _WORD.finditer(data.lower())]
                edges = [0, *(x for s in spans for x in (at[s["start"]][0], at[s["end"] - 1][1])), len(data)]
                text = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode("utf-8", "surrogatepass")
            out.append(text)
        names = [x for x in batch.schema.names if x != "_spans"]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if x == "text" else batch.column(x) for x in names], names=names)


def remove(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the spans that ``find_benchmark`` found: from a span's first word to its last, with all between.
    Spans depend on the text alone, so they are joined by its digest; only texts with spans are."""
    hit = found.where(F.size("spans") > 0).groupBy("text_sha256").agg(F.first("spans").alias("_spans"))
    digest = F.unhex(F.sha2(F.col("text"), 256))
    both = docs.withColumn("_digest", digest).join(hit, F.col("_digest") == F.col("text_sha256"), "left").drop("_digest", "text_sha256")
    return both.mapInArrow(_cut, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of FOUND."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.transform("items", lambda x: x.cast("string")), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SQL_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
  i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
  p AS (SELECT DISTINCT item_id, array_to_string(w[a:a + {WINDOW - 1}], ' ') AS g, least(len(w), {WINDOW}) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS a FROM i WHERE len(w) > 0)),
  o AS (SELECT r, a, n, array_to_string(w[a:a + n - 1], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS a FROM d), (SELECT DISTINCT n FROM p) WHERE a + n - 1 <= len(w)),
  h AS (SELECT o.r, o.a, o.n, p.item_id FROM o JOIN p ON o.g = p.g AND o.n = p.n),
  c AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS word FROM h) GROUP BY r),
  e AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY r)
  SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN e ON d.r = e.r"""
