"""Best-fit packing by minimum bin slack.

A document's tokens, with an end id, are cut only where it is longer than a sequence. The multiset of piece lengths is
a histogram of at most ``capacity`` entries, whatever the number of documents; the packing is solved on it: for each
bin the longest piece left is put in, then a bitset subset-sum over the lengths left finds the fullest feasible
combination, and that combination is removed as often as the histogram holds it. Pieces then take their places by
their rank among the pieces of their length, which is computed in a distributed way.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .batches import Memo, map_texts, process_memo

CAPACITY = 4096
END_ID = 1
#: ASCII signs that the tokenizer keeps apart from letters before them, without those of special tokens.
SIGNS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"
#: Strings of signs whose ids a worker keeps.
MOST_SIGNS = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_encoder(path: str):
    """A function from chunks without space or line feed to their ids as little-endian 32-bit bytes.

    Letters, with ASCII signs at the end or without, are what nearly all chunks are. The tokenizer never joins letters
    with those signs, so where its own normaliser (composed, lower case) leaves a word a string of letters, the word and
    the signs have ids of their own, and words are encoded many at a time: every word's last token, and no other, is one
    that ends a word in the vocabulary. Latin-1 letters are composed, and all of them are letters to the tokenizer, so
    their words, lowered, go through its model without its normaliser and pattern. A word that is ``known`` already isn't
    encoded again for other signs. All other chunks are encoded as they are.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tokenizer, of_words = Tokenizer.from_file(path), Tokenizer.from_file(path)
    of_words.normalizer = normalizers.Sequence([])
    of_words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    signs = {"": b""}

    def each(chunks: list[str]) -> list[bytes]:
        return [little_endian(array("I", x.ids)) for x in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def of_letters(words: list[str], encoder: Tokenizer) -> dict[str, bytes]:
        out = {}
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            ids = array("I", encoder.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids)
            last = (np.flatnonzero(ends[np.frombuffer(ids, np.uint32)]) * 4 + 4).tolist()
            if len(last) == len(some) and last[-1] == 4 * len(ids):
                raw = little_endian(ids)
                out.update(zip(some, [raw[i:j] for i, j in zip([0, *last], last)], strict=True))  # noqa: B905
            else:  # letters to Python that the tokenizer splits
                out.update(zip(some, each(some), strict=True))
        return out

    def encode(chunks: list[str], known: dict[str, bytes] = {}) -> list[bytes]:  # noqa: B006
        stems, tails, plain, other, odd = [], [], {}, {}, {}
        for chunk in chunks:
            word = chunk.rstrip(SIGNS)
            tail = chunk[len(word) :]
            if word.isalpha():
                if word.isascii():
                    word = word.lower()
                    if word not in known:
                        plain[word] = None
                elif word in known:
                    pass
                elif is_latin(word):
                    word = word.lower()
                    plain[word] = None
                elif normal(word).isalpha():
                    other[word] = None
                else:
                    word, tail = chunk, ""
                    odd[word] = None
            else:
                word, tail = chunk, ""
                odd[word] = None
            stems.append(word)
            tails.append(tail)
        new = [t for t in set(tails) if t not in signs]
        if len(signs) + len(new) > MOST_SIGNS:
            signs.clear()
            new = list(set(tails))
        signs.update(zip(new, each(new), strict=True))
        found = of_letters(list(plain), of_words) | of_letters(list(other), tokenizer)
        found.update(zip(odd, each(list(odd)), strict=True))
        return [(found[w] if w in found else known[w]) + signs[t] for w, t in zip(stems, tails, strict=True)]

    return encode


def is_latin(word: str) -> bool:
    try:
        word.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def little_endian(ids) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def split_words(text: str | None) -> list[str]:
    """Chunks whose ids, joined, are the text's ids: the tokenizer drops white space and no merge crosses it.

    Only space and line feed split; rarer white space stays inside a chunk for the tokenizer to deal with. A text of
    Latin-1 characters is lowered first: none of them combines with another or has a lower case of several characters,
    so the tokenizer, which lowers too, gives the same ids; unless the text may spell a special token.
    """
    if not text:
        return []
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    return text.replace("\n", " ").split(" ")


def encoder_memo(path: str) -> Memo:
    """Ids by chunk, in which the encoder finds words that it knows with other signs."""
    encode = word_encoder(path)
    memo = Memo(lambda chunks: encode(chunks, memo.known), 900_000)
    return memo


def piece_maker(path: str, capacity: int):
    """Per task: a function from (doc_id, text) to its pieces. Equal words are encoded once while the memo holds."""

    def make():
        memo = process_memo(("packing", path), lambda: encoder_memo(path))
        end, width = END_ID.to_bytes(4, "little"), 4 * capacity

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            words = [split_words(x) for x in part.column("text").to_pylist()]
            ids_of = memo.learn(set().union(*words)).__getitem__
            out: list[list] = [[], [], [], [], []]
            for doc_id, ws in zip(part.column("doc_id").to_pylist(), words, strict=True):
                ids = b"".join(map(ids_of, ws)) + end
                for k, at in enumerate(range(0, len(ids), width)):
                    piece = ids[at : at + width]
                    for column, x in zip(out, (doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                        column.append(x)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

        return step

    return map_texts(make)


def fullest(lengths: list[int], counts: Counter, capacity: int) -> Counter:
    """The combination of available ``lengths`` (descending) with the largest sum up to ``capacity``.

    Bit s of ``reach`` says that sum s can be made. Counts enter by powers of two; the states before each step are kept
    to walk back.
    """
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in lengths:
        left, take = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> capacity:
            break
    best, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] += take
            best -= length * take
    return chosen


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Counter]]:
    """Bins as (how many alike, lengths in each). Every length of ``histogram`` is used up; none is over ``capacity``."""
    left = Counter({k: v for k, v in histogram.items() if v > 0})
    if left and (max(left) > capacity or min(left) < 1):
        raise ValueError("a piece has a length outside 1 to the capacity")
    bins = []
    lengths = sorted(left, reverse=True)
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        room = capacity - longest
        chosen = fullest([x for x in lengths if x <= room and left[x] > 0], left, room) if room else Counter()
        left[longest] += 1
        chosen[longest] += 1
        times = min(left[k] // n for k, n in chosen.items())
        bins.append((times, chosen))
        for k, n in chosen.items():
            left[k] -= times * n
        lengths = [x for x in lengths if left[x] > 0]
    return bins


def plan_rows(bins: list[tuple[int, Counter]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, number in each sequence, offset of the first there)."""
    rows, used, sequence = [], Counter(), 0
    for times, chosen in bins:
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], used[length] + times * n, sequence, n, offset))
            used[length] += times * n
            offset += n * length
        sequence += times
    return rows


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Reads ``doc_id`` and ``text`` of ``docs`` and no other column. Null and empty texts are one piece, the end id
    alone. Whole texts are encoded, however long. Rows that repeat a doc_id, or have none, are documents of their own
    and take places of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = common.materialise(rows.mapInArrow(piece_maker(tokenizer, capacity), PIECES), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    plan = spark.createDataFrame(
        plan_rows(solve(histogram, capacity)),
        "_len long, _from long, _to long, _sequence long, _each long, _offset long",
    )
    ranked = common.number_within(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_at", sum(histogram.values()))
    # the plan's size is bounded by the capacity (a row per length and kind of bin), not by the documents
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_len")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")))
    nth = F.col("_at") - F.col("_from")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + F.expr("(_at - _from) div _each")).alias("sequence_id"),
        (F.col("_offset") + (nth % F.col("_each")) * F.col("length")).alias("offset"),
    )
