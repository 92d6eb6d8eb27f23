"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes words: each begins at a space mark that follows other text, since no piece of the vocabulary holds a
mark after another character. Equal words are encoded once. Words are cut further where two characters meet that stand
next to each other in no piece, as no merge can cross there; what is left are segments. All segments to encode lie in one
flat numpy array of symbols. Each round takes, per segment, the best rank among its adjacent pairs (a segmented minimum),
merges the pairs of that rank, and compacts the array; segments without a pair are done.

The library merges the best score first and the leftmost of equals. Where nothing that a merged piece can join ranks
before the piece itself, all its pairs are merged at once (of overlapping ones those that the leftmost leaves). Where
something does, it is merged next and may take what is near, so of pairs that lie nearer to each other than two of the
longest pieces only the leftmost is merged in a round. Both give the library's ids. What a segment (a very long text
without spaces) has left after ROUNDS rounds is merged by the same rule with a heap, in n log n steps.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Memo, map_texts, process_memo

MARK = "▁"
ROUNDS = 1000
NO_PAIR = np.int32(2**31 - 1)
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Symbols and ranked pairs of a SentencePiece BPE model with byte fallback and no normalisation but the marks."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        self.byte_id = {}
        pieces: dict[str, tuple[int, float]] = {}
        self.text = [b""] * size
        for i in range(size):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                pieces[piece] = (i, m.get_score(i))
                self.text[i] = piece.replace(MARK, " ").encode()
        if len(self.byte_id) < 256:
            raise ValueError("the model has no byte fallback")
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a mark after another character")
        # symbols: the pieces by their ids, then single characters that are only parts of pieces
        self.symbol = {p: i for p, (i, _) in pieces.items()}
        for p in pieces:
            for c in p:
                self.symbol.setdefault(c, size + len(self.symbol))
        self.symbol = {p: (self.symbol[p] if p in pieces else size + k) for k, p in enumerate(self.symbol)}
        self.size, self.n_symbols = size, size + len(self.symbol)
        scores = sorted({s for _, s in pieces.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        found = {}
        for p, (i, s) in pieces.items():
            for k in range(1, len(p)):
                if (a := self.symbol.get(p[:k])) is not None and (b := self.symbol.get(p[k:])) is not None:
                    found[a * self.n_symbols + b] = (rank[s], i)
        # ranks whose pieces join nothing that ranks before them or as they do
        made = {i: rank[s] for i, s in pieces.values()}
        self.quiet = np.ones(len(scores) + 1, bool)
        for k, (r, _) in found.items():
            for part in divmod(k, self.n_symbols):
                if r <= made.get(part, -1):
                    self.quiet[made[part]] = False
        self.reach = 2 * max(map(len, pieces))
        #: Pairs of characters that stand next to each other in a piece.
        self.touching = np.unique(np.array([ord(a) << 21 | ord(b) for p in pieces for a, b in zip(p, p[1:], strict=False)], np.int64))
        self.pairs = found
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k][0] for k in self.keys.tolist()], np.int32)
        self.merged = np.array([found[k][1] for k in self.keys.tolist()], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs, and their places in the table; negative symbols (unknown characters) pair with nothing."""
        key = left.astype(np.int64) * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NO_PAIR), at

    def ids(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if 0 <= s < self.size:
                out.append(s)
            else:  # a character that is no piece: its bytes
                c = self.char(s)
                out.extend(self.byte_id[b] for b in c.encode())
        return out

    @lru_cache(maxsize=None)  # noqa: B019  as many entries as the model has characters
    def _spare(self) -> dict[int, str]:
        return {i: p for p, i in self.symbol.items() if i >= self.size}

    def char(self, s: int) -> str:
        return chr(-s - 1) if s < 0 else self._spare()[s]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [self.ids(s) if min(s, default=0) < 0 or max(s, default=0) >= self.size else s for s in self.by_rounds(words)]

    def by_rounds(self, words: list[str]) -> list[list[int]]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        table = self._by_point()
        symbol = table[np.minimum(points, len(table) - 1)]
        strange = symbol == self.n_symbols
        symbol = np.where(strange, -points - 1, symbol).astype(np.int32)
        owner = np.repeat(np.arange(len(words)), lengths)
        # a segment ends with its word and where no piece has the two characters side by side
        meet = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.touching, meet), len(self.touching) - 1)
        apart = (owner[:-1] != owner[1:]) | (self.touching[at] != meet)
        segment = np.r_[0, np.cumsum(apart)] if len(points) else np.zeros(0, np.int64)
        begin = np.arange(len(points))
        owner = owner[np.r_[True, apart]] if len(points) else owner
        done_segment, done_symbol = [], []
        rank = np.full(len(symbol), NO_PAIR, np.int32)  # of the pair that begins here
        place = np.zeros(len(symbol), np.int64)
        inside = np.flatnonzero(segment[:-1] == segment[1:])
        rank[inside], place[inside] = self.rank_of(symbol[inside], symbol[inside + 1])
        rounds = 0
        while len(symbol):
            if (rounds := rounds + 1) > ROUNDS:
                cuts = np.flatnonzero(segment[1:] != segment[:-1]) + 1
                for of, left in zip(segment[np.r_[0, cuts]].tolist(), np.split(symbol, cuts), strict=True):
                    done_symbol.append(np.array(self.by_heap(left.tolist()), np.int32))
                    done_segment.append(np.full(len(done_symbol[-1]), of))
                break
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(segment)])
            live = best < NO_PAIR
            if not live.all():
                keep = np.repeat(live, sizes)
                done_segment.append(segment[~keep])
                done_symbol.append(symbol[~keep])
                symbol, segment, rank, place, begin = symbol[keep], segment[keep], rank[keep], place[keep], begin[keep]
                best, sizes = best[live], sizes[live]
                if not len(symbol):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            # of pairs that overlap every second one, from the left; of such that could meet the leftmost
            alone = np.r_[True, (segment[hits[1:]] != segment[hits[:-1]]) | (begin[hits[1:]] - begin[hits[:-1]] >= self.reach)]
            first = np.r_[True, hits[1:] != hits[:-1] + 1]
            since = np.arange(len(hits)) - np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0))
            hits = hits[np.where(self.quiet[rank[hits]], since % 2 == 0, alone)]
            symbol[hits] = self.merged[place[hits]]
            keep = np.ones(len(symbol), bool)
            keep[hits + 1] = False
            at = hits - np.arange(len(hits))  # where the merged symbols are after the compaction
            symbol, segment, rank, place, begin = symbol[keep], segment[keep], rank[keep], place[keep], begin[keep]
            last = len(symbol) - 1
            rank[at] = NO_PAIR
            for left in (at, at - 1):
                ok = left[(left >= 0) & (left < last)]
                ok = ok[segment[ok] == segment[ok + 1]]
                rank[ok], place[ok] = self.rank_of(symbol[ok], symbol[ok + 1])
        out: list[list[int]] = [[] for _ in words]
        if done_segment:
            segment, symbol = np.concatenate(done_segment), np.concatenate(done_symbol)
            order = np.argsort(segment, kind="stable")
            word, symbol = owner[segment[order]], symbol[order]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]).tolist()
            values = symbol.tolist()
            for w, a, b in zip(word[starts].tolist(), starts, [*starts[1:], len(values)], strict=True):
                out[w] = values[a:b]
        return out

    @lru_cache(maxsize=None)  # noqa: B019
    def _by_point(self) -> np.ndarray:
        """Symbol by code point; n_symbols for none. The last entry stands for all larger points."""
        chars = {ord(p): i for p, i in self.symbol.items() if len(p) == 1}
        table = np.full(max(chars) + 2, self.n_symbols, np.int64)
        table[list(chars)] = list(chars.values())
        return table

    def by_heap(self, symbols: list[int]) -> list[int]:
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []
        n = self.n_symbols

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and symbols[i] >= 0 and symbols[j] >= 0 and (hit := self.pairs.get(symbols[i] * n + symbols[j])):
                heapq.heappush(heap, (hit[0], i, symbols[i], symbols[j], hit[1]))

        for i in range(len(symbols) - 1):
            offer(i)
        gone = [False] * len(symbols)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j], after[i] = merged, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [s for s, g in zip(symbols, gone, strict=True) if not g]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.text[i] for i in ids])


def words_of(text: str) -> list[str]:
    """The marked words whose ids, joined, are the text's ids."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return _WORDS.findall(MARK + text.replace(" ", MARK))
    return (MARK + text.replace(" ", " " + MARK)).split(" ")


def encode(text: str, vocabulary: Vocabulary) -> list[int]:
    return [i for ids in vocabulary.encode(words_of(text)) for i in ids]


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """Pieces joined, marks as spaces, without the one space put before the text; broken bytes become U+FFFD."""
    out = vocabulary.decode(ids)
    return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def text_digester(path: str):
    def make():
        def start() -> Memo:
            vocabulary = Vocabulary(path)

            def compute(words: list[str]) -> list[tuple[str, bytes]]:
                return [(",".join(map(str, ids)), vocabulary.decode(ids)) for ids in vocabulary.encode(words)]

            return Memo(compute, 400_000)

        memo = process_memo(("pieces", path), start)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [words_of(x) if x else [] for x in part.column("text").to_pylist()]
            known = memo.learn(set().union(*texts))
            out: list[list] = [[], [], []]
            for words in texts:
                found = [known[w] for w in words]
                ids = ",".join([x[0] for x in found])
                decoded = b"".join([x[1] for x in found])
                out[0].append(ids.count(",") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids.encode()).hexdigest())
                out[2].append(hashlib.sha256(decoded[1:] if decoded[:1] == b" " else decoded).hexdigest())
            columns = [part.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return map_texts(make)


def token_batches(path: str):
    def make():
        vocabulary = Vocabulary(path)
        memo = Memo(lambda words: vocabulary.encode(words), 400_000)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [words_of(x) if x else [] for x in part.column("text").to_pylist()]
            known = memo.learn(set().union(*texts))
            ids = [[i for w in words for i in known[w]] for words in texts]
            decoded = [decode(x, vocabulary) for x in ids]
            columns = [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

        return step

    return map_texts(make)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def tokenize(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>), decoded: the tokens of every whole text and the text they decode to.

    Nulls and empty texts have no ids and decode to the empty text. Rows are independent of each other: repeated rows
    and ids give repeated results, an empty table an empty one; columns other than doc_id and text are not read.
    """
    return _narrow(docs).mapInArrow(token_batches(model or model_path()), "doc_id long, ids array<int>, decoded string")


def digest_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """As ``tokenize``, but only the number of ids and SHA-256 digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _narrow(docs).mapInArrow(text_digester(model or model_path()), RESULT)
