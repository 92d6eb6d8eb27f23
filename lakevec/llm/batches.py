"""Walk over Arrow batches of texts in slices of bounded size."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handed to an operator at once; a longer text comes alone.
SLICE_BYTES = 1 << 20
#: The C library's way to give free memory back, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def give_back() -> None:
    """Free memory goes back to the system; a worker that Spark keeps idle would hold what its largest slice took."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with about SLICE_BYTES of ``column`` each (one row at least)."""
    sizes = pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def _begin(make: Callable) -> Callable:
    """A task's function for a slice. Of the module, as what this worker keeps is the module's and not the closure's."""
    _wanted.clear()
    step = make()
    for key in [k for k in _memo if k not in _wanted]:
        del _memo[key]  # of an operator that ran before in this worker
    return step


def map_texts(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], column: str = "text"):
    """A function for ``mapInArrow``: ``make()`` runs once per task and gives the function for a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = _begin(make)
        try:
            for batch in batches:
                for part in text_slices(batch, column):
                    out = step(part)
                    if out is not None and out.num_rows:
                        yield out
        finally:
            step = batch = part = out = None
            give_back()

    return run


class Memo:
    """Results by chunk of text, of bounded size: when full, what the present slice doesn't use is forgotten.

    Forgetting costs time but changes no result.
    """

    def __init__(self, compute: Callable[[list[str]], list], most: int = 600_000):
        self.compute, self.most, self.known = compute, most, {}

    def learn(self, chunks: set[str]) -> dict[str, object]:
        """A table with the results of ``chunks`` (and of others)."""
        new = chunks.difference(self.known)
        if new:
            if len(self.known) + len(new) > self.most:
                self.known = {x: self.known[x] for x in chunks.difference(new)}
            some = list(new)
            self.known.update(zip(some, self.compute(some), strict=True))
        return self.known


_memo: dict = {}
_wanted: set = set()


def process_memo(key: tuple, make: Callable[[], Memo]) -> Memo:
    """The memo that this Python worker's tasks share for ``key``. A worker keeps that of one operator at a time."""
    _wanted.add(key)
    if key not in _memo:
        _memo.clear()
        _memo[key] = make()
    return _memo[key]
