"""Word shingles of whole texts as 64-bit hashes, many texts at a time in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words are hashed at once; a longer text comes alone.
PART = 1 << 19
_RANDOM = np.random.default_rng(6)
_BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[[32, *range(9, 14)]] = 0
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_STEP = np.uint64(_RANDOM.integers(1, 2**63)) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of ``x`` moves every bit of the result."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and how many words the texts have before each of them (one entry more)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    space = _IS_SPACE[raw]
    begins = ~space
    begins[1:] &= space[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = ~space[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    sizes = np.diff(np.r_[starts, len(raw)])
    at = np.arange(starts[0], len(raw)) - np.repeat(starts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _STEP, np.uint64))
    values = np.add.reduceat(_BYTE[raw[starts[0] :]] * powers[at], starts - starts[0])
    return mix(values), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; with fewer words the whole sequence; none without words."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    out, start = [], 0
    while start < len(texts):  # parts of about PART bytes keep the arrays small
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + PART, "right")))
        out += _shingle_sets(texts[start:stop], words)
        start = stop
    return out


def _shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    hashes, bounds = word_hashes(texts)
    n = len(hashes)
    whole = max(0, n - words + 1)  # places where so many words begin
    full = np.zeros(whole, np.uint64)
    for k in range(words):
        full += hashes[k : k + whole] * _PLACE[k]
    full = mix(full, words)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            s = np.sort(full[a : b - words + 1])
            fresh = s[1:] != s[:-1]
            out.append(s if fresh.all() else s[np.r_[True, fresh]])
        elif b > a:
            out.append(mix((hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True), b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
