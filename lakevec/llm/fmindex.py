"""An FM-index of word sequences in numpy: suffix order, transformed text in a wavelet tree, sampled suffix positions.

The text is a flat array of word numbers from 1 on, in which every sequence ends with 0. Ends are ordered by where they
stand, so that no comparison goes on behind one and suffixes are told apart after a sequence's length at the latest.
Everything works on whole arrays of patterns or rows at once.
"""

from __future__ import annotations

import numpy as np

#: Every so many words, and at every beginning, a suffix's position is kept.
SAMPLED = 32
#: Rows that are located at once.
LOCATED = 1 << 20


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Where the suffixes of ``text`` (which ends with 0) begin, in order: doubling, of which each round sorts only those
    suffixes that are not told apart yet."""
    n, ends = len(text), np.flatnonzero(text == 0)
    symbols = text.astype(np.int64) + len(ends)
    symbols[ends] = np.arange(len(ends))
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    h = max(1, 62 // bits)
    padded = np.concatenate([symbols, np.zeros(h, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(h):
        key = key << bits | padded[j : j + n]
    order = np.argsort(key)
    rank, tied = np.empty(n, np.int64), np.arange(n)
    key = key[order]
    suffixes = order
    while len(tied):
        fresh = np.ones(len(tied), bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.flatnonzero(fresh)
        rank[suffixes] = np.repeat(tied[group], np.diff(np.append(group, len(tied))))
        alone = fresh & np.append(fresh[1:], True)
        tied, suffixes = tied[~alone], suffixes[~alone]
        key = rank[suffixes] * n + rank[np.minimum(suffixes + h, n - 1)]
        at = np.argsort(key)
        suffixes, key = suffixes[at], key[at]
        order[tied] = suffixes
        h *= 2
    return order


class Bits:
    """Packed bits and how many ones come before each 64 of them."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def pack(cls, bits: np.ndarray) -> Bits:
        raw = np.zeros(8 * (len(bits) // 64 + 1), np.uint8)
        packed = np.packbits(bits, bitorder="little")
        raw[: len(packed)] = packed
        return cls(raw.view("<u8"))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before ``at``."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & below)


class WaveletTree:
    """Symbols level by level, highest bit first; each level has its zeros' symbols before its ones' in the next."""

    def __init__(self, levels: list[Bits], zeros: list[int], symbols: int):
        self.levels, self.zeros = levels, zeros
        self.first = self.down(np.arange(symbols), np.zeros(symbols, np.int64))

    @classmethod
    def of(cls, values: np.ndarray, symbols: int) -> WaveletTree:
        levels, zeros, now = [], [], values.astype(np.uint32)
        for bit in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            ones = (now >> np.uint32(bit)) & np.uint32(1) == 1
            levels.append(Bits.pack(ones))
            now = np.concatenate([now[~ones], now[ones]])
            zeros.append(len(ones) - int(ones.sum()))
        return cls(levels, zeros, symbols)

    def down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where place ``at`` lies on the lowest level if one follows the bits of ``symbol``."""
        for i, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = level.rank(at)
            at = np.where(symbol >> (len(self.levels) - 1 - i) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``at``."""
        return self.down(symbol, at) - self.first[symbol]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``at`` and how often they occur before."""
        symbol = np.zeros(len(at), np.int64)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one, ones = level.get(at), level.rank(at)
            at = np.where(one, zeros + ones, at - ones)
            symbol = symbol << 1 | one
        return symbol, at - self.first[symbol]


class FMIndex:
    """``less[c]`` is how many symbols of the text are smaller than c; ``marks`` are the rows whose position is kept."""

    def __init__(self, tree: WaveletTree, less: np.ndarray, marks: Bits, samples: np.ndarray):
        self.tree, self.less, self.marks, self.samples = tree, less, marks, samples

    @classmethod
    def build(cls, text: np.ndarray, symbols: int) -> FMIndex:
        order = suffix_order(text)
        previous = text[order - 1]  # of the first suffix the last symbol, an end
        kept = (order % SAMPLED == 0) | (previous == 0)
        less = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=less[1:])
        return cls(WaveletTree.of(previous, symbols), less, Bits.pack(kept), order[kept].astype(np.int32 if len(text) < 1 << 31 else np.int64))

    def __len__(self) -> int:
        return int(self.less[-1])

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows, from and to, of the suffixes that begin with each pattern; backwards from its last word.

        A pattern is a row of ``patterns`` of which the first ``lengths`` columns count; words are symbols from 1 on."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self), np.int64)
        live = np.flatnonzero(lengths > 0)
        low[lengths <= 0] = high[lengths <= 0] = 0
        step = 0
        while len(live):
            c = patterns[live, lengths[live] - 1 - step].astype(np.int64)
            found = self.less[c] + self.tree.rank(np.concatenate([c, c]), np.concatenate([low[live], high[live]])).reshape(2, -1)
            low[live], high[live] = found
            step += 1
            live = live[(found[0] < found[1]) & (lengths[live] > step)]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of ``rows`` begin: backwards through the text until a position is kept."""
        out, at, steps, left = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(left):
            kept = self.marks.get(at)
            out[left[kept]] = self.samples[self.marks.rank(at[kept])] + steps
            left, at = left[~kept], at[~kept]
            symbol, before = self.tree.read(at)
            at, steps = self.less[symbol] + before, steps + 1
        return out

    def occurrences(self, patterns: np.ndarray, lengths: np.ndarray):
        """(pattern, position) of all occurrences, in arrays of about LOCATED."""
        low, high = self.search(patterns, lengths)
        found = np.flatnonzero(high > low)
        n = high[found] - low[found]
        ends = np.cumsum(n)
        start = 0
        while start < len(found):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + LOCATED, "right")))
            of, m = found[start:stop], n[start:stop]
            rows = np.repeat(low[of] - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())
            yield np.repeat(of, m), self.locate(rows)
            start = stop

    def state(self) -> dict:
        dump = lambda x: np.ascontiguousarray(x).tobytes()
        return {
            "less": dump(self.less.astype("<i8")), "levels": [dump(x.words) for x in self.tree.levels], "zeros": self.tree.zeros,
            "marks": dump(self.marks.words), "wide": self.samples.dtype.itemsize == 8, "samples": dump(self.samples),
        }

    @classmethod
    def of_state(cls, s: dict) -> FMIndex:
        bits = lambda x: Bits(np.frombuffer(x, "<u8"))
        less = np.frombuffer(s["less"], "<i8")
        return cls(WaveletTree([bits(x) for x in s["levels"]], list(s["zeros"]), len(less) - 1), less, bits(s["marks"]), np.frombuffer(s["samples"], "<i8" if s["wide"] else "<i4"))
