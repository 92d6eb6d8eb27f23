"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

An index knows which document has which line key (a posting), and, dealt to shards by key, how many documents have a
key and the first of them (the reference counts). Each shard has a cuckoo filter over its keys. Keys come to a shard in
portions; one that the filter doesn't know is new for certain and is appended, and only the others are looked up among
the exact counts. The same filter decides which lines of a document are looked up at all when the index is applied.
When documents go, counts fall, the next document becomes a key's first, and the filter forgets keys that no document
has any more. So the index after insertions and deletions equals that of the documents that are left.

Keys are BLAKE2b digests of 128 bits. Postings of one key are counted in each task before they are dealt, and the keys
that very many documents have, whose number is bounded, are looked up where their postings are: a line that a third of
all documents have fills no shard.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .batches import map_texts
from .shingles import mix

WHITE = b" \t\n\x0b\x0c\r"
#: Code points that a key needs to count, and documents that need to have it.
LEAST_POINTS, LEAST_DOCS = 10, 2
POSTINGS_PER_SHARD = 400_000
#: Postings that a task counts at once before they are dealt, and keys that a shard takes in at once.
COUNTED, PORTION = 500_000, 50_000
#: Keys in as many documents as a shard has postings, or in this part of all postings, are looked up without a shuffle:
#: not more of them than this.
HOT_KEYS = 100_000
POSTED = ["doc_id", "h1", "h2"]
POSTING = "doc_id long, h1 long, h2 long"
STATE = "shard int, h1 long, h2 long, n_docs long, first_doc long, filter binary"


def line_key(line: bytes) -> bytes | None:
    """The digest of a line's key; None if the key is too short. bytes.lower and strip touch ASCII only."""
    key = line.strip(WHITE).lower()
    if len(key) < LEAST_POINTS or (len(key) < 4 * LEAST_POINTS and len(key.decode()) < LEAST_POINTS):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """Fingerprints of 16 bits (0: free) in buckets of four; a key's buckets are b and b ^ hash(fingerprint)."""

    SLOTS, FILL = 4, 0.8

    def __init__(self, keys: int = 0, slots: np.ndarray | None = None):
        if slots is None:
            slots = np.zeros((1 << max(4, int(np.ceil(np.log2(max(1, keys) / (self.SLOTS * self.FILL))))), self.SLOTS), np.uint16)
        self.slots = slots
        self.mask = np.int64(len(slots) - 1)

    @property
    def room(self) -> int:
        return int(self.slots.size * self.FILL)

    def _at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys.view(np.uint64))
        mark = (h >> np.uint64(48)).astype(np.uint16)
        return np.where(mark == 0, 1, mark).astype(np.uint16), (h & np.uint64(0x7FFFFFFF)).astype(np.int64) & self.mask

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ ((mix(mark.astype(np.uint64), 7) & np.uint64(0x7FFFFFFF)).astype(np.int64) & self.mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, a = self._at(keys)
        b = self._other(mark, a)
        return (self.slots[a] == mark[:, None]).any(1) | (self.slots[b] == mark[:, None]).any(1)

    def insert(self, keys: np.ndarray, rounds: int = 2000) -> bool:
        """Whether all keys found a place; if not, the filter is to be built anew with more room."""
        mark, bucket = self._at(keys)
        turn = np.random.default_rng(len(keys))
        for _ in range(rounds):
            for _ in range(2):
                # one newcomer per bucket at a time takes a free slot
                _, first = np.unique(bucket, return_index=True)
                free = self.slots[bucket[first]] == 0
                placed = first[free.any(1)]
                self.slots[bucket[placed], free[free.any(1)].argmax(1)] = mark[placed]
                left = np.ones(len(mark), bool)
                left[placed] = False
                mark, bucket = mark[left], bucket[left]
                if not len(mark):
                    return True
                bucket = self._other(mark, bucket)
            # of those left one per full bucket pushes another fingerprint out
            _, first = np.unique(bucket, return_index=True)
            full = first[(self.slots[bucket[first]] != 0).all(1)]
            slot = turn.integers(0, self.SLOTS, len(full))
            out = self.slots[bucket[full], slot]
            self.slots[bucket[full], slot] = mark[full]
            mark[full] = out
            bucket[full] = self._other(out, bucket[full])
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Forget keys that were inserted, one fingerprint for each."""
        for mark, a in zip(*self._at(keys), strict=True):
            for bucket in (a, int(self._other(mark[None], np.array([a]))[0])):
                at = np.flatnonzero(self.slots[bucket] == mark)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break

    @classmethod
    def over(cls, keys: np.ndarray) -> CuckooFilter:
        room = len(keys)
        while True:
            made = cls(room)
            if made.insert(keys):
                return made
            room = 2 * max(room, 8)

    def dump(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(slots=np.frombuffer(raw, "<u2").reshape(-1, cls.SLOTS).copy())


class References:
    """A shard: exact counts, sorted by key, and their filter."""

    def __init__(self, h1, h2, n_docs, first_doc, filter_: CuckooFilter):
        order = np.lexsort((h2, h1))
        self.h1, self.h2, self.n_docs, self.first_doc = (np.array(x, np.int64)[order] for x in (h1, h2, n_docs, first_doc))
        self.filter = filter_

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Places of keys, -1 for those that aren't there."""
        at, stop = np.searchsorted(self.h1, h1), np.searchsorted(self.h1, h1, "right")
        out = np.full(len(h1), -1)
        open_ = np.flatnonzero(at < stop)
        while len(open_):
            same = self.h2[at[open_]] == h2[open_]
            out[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < stop[open_]]
        return out

    def insert(self, h1, h2, n, first) -> References:
        place = np.full(len(h1), -1)
        known = np.flatnonzero(self.filter.contains(h1)) if len(self.h1) else np.zeros(0, np.int64)
        place[known] = self.find(h1[known], h2[known])
        old, new = place >= 0, place < 0
        self.n_docs[place[old]] += n[old]
        self.first_doc[place[old]] = np.minimum(self.first_doc[place[old]], first[old])
        keys = np.r_[self.h1, h1[new]]
        filter_ = self.filter
        if len(keys) > filter_.room or not filter_.insert(h1[new]):
            filter_ = CuckooFilter.over(keys)
        return References(keys, np.r_[self.h2, h2[new]], np.r_[self.n_docs, n[new]], np.r_[self.first_doc, first[new]], filter_)

    def delete(self, h1, h2, n, next_first) -> References:
        place = self.find(h1, h2)
        if (place < 0).any():
            raise ValueError("a posting is deleted that the reference counts don't have")
        self.n_docs[place] -= n
        self.first_doc[place] = next_first
        gone = self.n_docs <= 0
        self.filter.delete(self.h1[gone])
        return References(*(x[~gone] for x in (self.h1, self.h2, self.n_docs, self.first_doc)), self.filter)


class LineIndex(NamedTuple):
    """``postings`` (POSTING) and ``state`` (STATE: a row per key, and one per shard with its filter)."""

    postings: DataFrame
    state: DataFrame
    shards: int


def _poster():
    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts, keys = part.column("doc_id"), [], []
        for text in part.column("text").cast(pa.large_binary()).to_pylist():
            own = {line_key(x) for x in text.split(b"\n")} - {None}
            counts.append(len(own))
            keys.extend(own)
        pairs = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
        at = pa.array(np.repeat(np.arange(len(counts)), counts))
        return pa.RecordBatch.from_arrays([ids.take(at), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["doc_id", "h1", "h2"])

    return step


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _postings(docs: DataFrame) -> DataFrame:
    rows = _narrow(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(map_texts(_poster), POSTING).distinct()


def counted(h1: np.ndarray, h2: np.ndarray, n: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once, with the sum of its counts and the smallest first document."""
    if not len(h1):
        return h1, h2, n, first
    order = np.lexsort((h2, h1))
    h1, h2, n, first = h1[order], h2[order], n[order], first[order]
    starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    return h1[starts], h2[starts], np.add.reduceat(n, starts), np.minimum.reduceat(first, starts)


def _count(batches):
    """Reference counts of a task's postings, COUNTED of them at a time."""
    waiting, size = [], 0

    def flush():
        doc_id, h1, h2 = (np.concatenate([b.column(c).to_numpy() for b in waiting]) for c in ("doc_id", "h1", "h2"))
        columns = counted(h1, h2, np.ones(len(h1), np.int64), doc_id)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["h1", "h2", "n_docs", "first_doc"])

    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= COUNTED:
            yield flush()
            waiting, size = [], 0
    if waiting:
        yield flush()


def _numbers(table: pa.Table) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in ("h1", "h2", "n_docs", "first_doc")]


def _references(state: pa.Table, room: int = 0) -> References:
    kept = state.filter(state.column("h1").is_null()).column("filter").to_pylist()
    return References(*_numbers(state.filter(state.column("h1").is_valid())), CuckooFilter.load(kept[0]) if kept else CuckooFilter(room))


def _shard(h2: str, shards: int):
    return F.pmod(h2, F.lit(shards)).cast("int")


def _update(state: DataFrame, delta: DataFrame, shards: int, delete: bool) -> DataFrame:
    """The state after the counts of ``delta`` (h1, h2, n_docs, first_doc) came or went."""

    def update(key, before, change):
        shard = key[0].as_py()
        refs, change = _references(before, len(change)), _numbers(change)
        if delete:
            refs = refs.delete(*change) if len(change[0]) else refs
        else:
            for i in range(0, len(change[0]), PORTION):
                refs = refs.insert(*counted(*(x[i : i + PORTION] for x in change)))
        n = len(refs.h1)
        columns = {"shard": pa.array([shard] * (n + 1), pa.int32())}
        for name in ("h1", "h2", "n_docs", "first_doc"):
            columns[name] = pa.concat_arrays([pa.array(getattr(refs, name), pa.int64()), pa.nulls(1, pa.int64())])
        columns["filter"] = pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([refs.filter.dump()], pa.binary())])
        return pa.table(columns)

    delta = delta.withColumn("shard", _shard("h2", shards))
    return state.groupBy("shard").cogroup(delta.groupBy("shard")).applyInArrow(update, STATE)


def empty_index(spark: SparkSession, shards: int) -> LineIndex:
    return LineIndex(spark.createDataFrame([], POSTING), spark.createDataFrame([], STATE), shards)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with ``docs`` too. Documents that it has already must be deleted before they come with a new text."""
    return _insert(index, common.materialise(_postings(docs), "postings"))


def _insert(index: LineIndex, new: DataFrame) -> LineIndex:
    delta = new.mapInArrow(_count, "h1 long, h2 long, n_docs long, first_doc long")
    state = common.materialise(_update(index.state, delta, index.shards, delete=False), "line-state")
    return LineIndex(index.postings.unionByName(new), state, index.shards)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents ``ids`` (doc_id), as if they had never been inserted."""
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    gone = index.postings.join(ids, "doc_id", "left_semi")
    stay = common.materialise(index.postings.join(ids, "doc_id", "left_anti"), "postings")
    keys = gone.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
    first = stay.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"))
    delta = keys.join(first, ["h1", "h2"], "left").select("h1", "h2", "n_docs", F.coalesce("first_doc", F.lit(-1).cast("long")).alias("first_doc"))
    return LineIndex(stay, common.materialise(_update(index.state, delta, index.shards, delete=True), "line-state"), index.shards)


def build_index(docs: DataFrame) -> LineIndex:
    """An index of ``docs`` with shards for about POSTINGS_PER_SHARD postings."""
    new = common.materialise(_postings(docs), "postings")
    shards = max(common.shuffle_partitions(docs.sparkSession), -(-new.count() // POSTINGS_PER_SHARD))
    return _insert(empty_index(docs.sparkSession, shards), new)


def _dropper(digest: bool):
    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            lines, dropped, kept = [], [], []
            for text, keys in zip(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("_keys").to_pylist(), strict=True):
                split = (text or b"").split(b"\n")
                lines.append(len(split))
                if keys:
                    gone = set(keys)
                    stay = [x for x in split if line_key(x) not in gone]
                    dropped.append(len(split) - len(stay))
                    text = b"\n".join(stay)
                else:
                    dropped.append(0)
                kept.append(hashlib.sha256(text or b"").hexdigest() if digest else text)
            columns = [part.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            columns.append(pa.array(kept, pa.string()) if digest else pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "kept_sha256" if digest else "text"])

        return step

    return map_texts(make)


def apply_index(index: LineIndex, docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that stays (``digest``: kept_sha256 instead) for every row of ``docs``.

    A line goes if its key has LEAST_POINTS code points or more, LEAST_DOCS documents of the index or more have it, and
    one with a smaller doc_id is its first. Null and empty texts are one empty line (a null text stays null). Rows that
    repeat a doc_id are one document; rows without one are not in the index and keep all lines. An empty table gives an
    empty result; columns other than doc_id and text are not read.
    """
    total = index.state.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    often = max(POSTINGS_PER_SHARD, -(-total // HOT_KEYS))
    hot = F.broadcast(index.state.where(F.col("n_docs") >= often).select("h1", "h2", "first_doc"))  # HOT_KEYS rows at most
    gone = index.postings.join(hot, ["h1", "h2"]).where("doc_id <> first_doc").select(*POSTED)
    rest = index.postings.join(hot, ["h1", "h2"], "left_anti").withColumn("shard", _shard("h2", index.shards))

    def look_up(key, state, asked):
        refs, (doc_id, h1, h2) = _references(state), (asked.column(c).to_numpy() for c in POSTED)
        hits = np.flatnonzero(refs.filter.contains(h1))  # what the filter doesn't know is not looked up
        place = refs.find(h1[hits], h2[hits])
        hits, place = hits[place >= 0], place[place >= 0]
        hits = hits[(refs.n_docs[place] >= LEAST_DOCS) & (refs.first_doc[place] != doc_id[hits])]
        return pa.table([pa.array(x[hits], pa.int64()) for x in (doc_id, h1, h2)], names=POSTED)

    gone = gone.unionByName(index.state.groupBy("shard").cogroup(rest.groupBy("shard")).applyInArrow(look_up, POSTING))
    digest_of = F.concat(*[F.unhex(F.lpad(F.hex(h), 16, "0")) for h in ("h1", "h2")])
    # not more keys than the document has lines
    keys = gone.groupBy("doc_id").agg(F.collect_list(digest_of).alias("_keys"))
    rows = _narrow(docs).join(keys, "doc_id", "left")
    last = "kept_sha256 string" if digest else "text string"
    return rows.mapInArrow(_dropper(digest), f"doc_id long, n_lines long, n_dropped long, {last}")


def dedup_lines(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``apply_index`` of the index of ``docs`` themselves."""
    return apply_index(build_index(docs), docs, digest)


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT doc_id, line, pos, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (
  SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.doc_id, k.line, k.pos, coalesce(f.first_doc <> k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
