"""Links between token sets by a dual traversal of a signature tree, in numpy.

The sets' shared tokens get one bit each (several tokens one bit, where the bitmaps would take too much memory; what a
set has beyond its bits is then added to every bound). A leaf holds a few sets, an inner node FAN nodes; every node has the OR of
its sets' bitmaps and the range of their sizes. Two nodes can hold a link only if their size ranges fit the similarity
and the bits that they have in common, which bound every overlap below them, reach the least overlap that the smaller
sizes ask for. For pairs of sets that survive to the leaves the bound is their overlap, or the overlap is counted.

Only components are wanted: node pairs whose sets are all in one component already are pruned as well.
"""

from __future__ import annotations

import numpy as np

FAN = 8
#: Node pairs looked at before components are brought up to date, and bytes of bitmaps compared at once.
PAIRS, BYTES = 4096, 32 << 20
#: Bytes that the bitmaps of all sets may take.
BITMAP_BYTES = 96 << 20


class Links:
    """Union-find over the sets 0 to n - 1; ``label`` (sets that are linked already share one) is optional."""

    def __init__(self, n: int, label: np.ndarray | None = None):
        self.parent = np.arange(n)
        if label is not None and n:
            _, first, group = np.unique(label, return_index=True, return_inverse=True)
            self.parent = first[group]

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            i, j = self.find(i), self.find(j)
            if i != j:
                self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up


def bitmaps(sets: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of 64-bit words for each set: a bit for each token that two sets or more have; and by how many such tokens
    each set exceeds its bits, which is 0 unless ``most`` bytes are too few for a bit each."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    tokens = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    fresh = np.r_[True, tokens[1:] != tokens[:-1]] if len(tokens) else np.zeros(0, bool)
    kind = np.cumsum(fresh) - 1
    shared = np.bincount(kind) > 1 if len(kind) else np.zeros(0, bool)
    bit = np.cumsum(shared) - 1
    keep = shared[kind] if len(kind) else np.zeros(0, bool)
    words = max(1, min((int(shared.sum()) + 63) // 64, most // (8 * len(sets))))
    bit, owner = bit[kind[keep]] % (64 * words), owner[keep]
    out = np.zeros((len(sets), words), np.uint64)
    np.bitwise_or.at(out, (owner, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    return out, np.bincount(owner, minlength=len(sets)) - np.bitwise_count(out).sum(1, dtype=np.int64)


def overlaps(bits: np.ndarray, other: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that rows ``a`` of ``bits`` and ``b`` of ``other`` have in common."""
    step = max(1, BYTES // (8 * bits.shape[1]))
    parts = [np.bitwise_count(bits[a[i : i + step]] & other[b[i : i + step]]).sum(1, dtype=np.int64) for i in range(0, len(a), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def may_link(common: np.ndarray, small_a, large_a, small_b, large_b, num: int, den: int) -> np.ndarray:
    """Whether sets within these size ranges that share ``common`` tokens at most can have a Jaccard of num / den.

    For sizes a and b: overlap * (num + den) >= num * (a + b), hence also a * den >= b * num and the other way round.
    """
    return (common * (num + den) >= num * (small_a + small_b)) & (large_a * den >= small_b * num) & (large_b * den >= small_a * num)


class Tree:
    """Levels from the leaves up; node i of a level has children i * FAN to i * FAN + FAN - 1 of the level below."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, excess: np.ndarray):
        self.levels = [(bits, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > 1:
            bits, small, large, excess = self.levels[-1]
            starts = np.arange(0, len(bits), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, starts, 0), np.minimum.reduceat(small, starts), np.maximum.reduceat(large, starts), np.maximum.reduceat(excess, starts)))

    def uniform(self, roots: np.ndarray) -> list[np.ndarray]:
        """For each node the component of all its sets, or -1."""
        out = [roots]
        for bits, *_ in self.levels[1:]:
            starts = np.arange(0, len(out[-1]), FAN)
            low, high = np.minimum.reduceat(out[-1], starts), np.maximum.reduceat(out[-1], starts)
            out.append(np.where(low == high, low, -1))
        return out


def link(sets: list[np.ndarray], num: int, den: int, label: np.ndarray | None = None, side: np.ndarray | None = None, most: int = BITMAP_BYTES) -> np.ndarray:
    """The component of each set (an index into ``sets``), by links of Jaccard num / den or more.

    Sets of equal ``label`` count as linked. With ``side`` (bits 1 and 2) only pairs of a set of side 1 and a set of
    side 2 are looked at; a set may be on both. Empty sets link with nothing.
    """
    n = len(sets)
    links = Links(n, label)
    if n < 2:
        return links.roots()
    sizes = np.fromiter(map(len, sets), np.int64, n)
    # neighbours in the order of the smallest tokens are similar, so that nodes are tight
    first = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
    order = np.lexsort((sizes, first))
    bits, excess = bitmaps([sets[i] for i in order.tolist()], most)
    sizes = sizes[order]
    exact = not excess.any()
    tree = Tree(bits, sizes, excess)
    sides = None
    if side is not None:
        sides = [side[order]]
        for _ in tree.levels[1:]:
            sides.append(np.bitwise_or.reduceat(sides[-1], np.arange(0, len(sides[-1]), FAN)))
    top = len(tree.levels) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    stale, uniform = True, []
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS:
            stack.append((level, a[PAIRS:], b[PAIRS:]))
            a, b = a[:PAIRS], b[:PAIRS]
        if stale:
            roots = links.roots()[order]
            uniform, stale = tree.uniform(roots), False
        node_bits, small, large, excess = tree.levels[level]
        keep = (uniform[level][a] != uniform[level][b]) | (uniform[level][a] < 0)
        if level == 0:
            keep &= (a != b) & (sizes[a] > 0) & (sizes[b] > 0)
        if sides is not None:
            x, y = sides[level][a], sides[level][b]
            keep &= ((x & 1 > 0) & (y & 2 > 0)) | ((x & 2 > 0) & (y & 1 > 0))
        a, b = a[keep], b[keep]
        # what a node shares with itself bounds nothing; its children are compared
        common = overlaps(node_bits, node_bits, a, b) + np.minimum(excess[a], excess[b])
        keep = may_link(common, small[a], large[a], small[b], large[b], num, den) | ((a == b) & (level > 0))
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if level == 0:
            if exact:
                links.union(order[a], order[b])
            else:
                for i, j in zip(order[a].tolist(), order[b].tolist(), strict=True):
                    if links.find(i) != links.find(j):
                        n_common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if may_link(n_common, len(sets[i]), len(sets[i]), len(sets[j]), len(sets[j]), num, den):
                            links.union(np.array([i]), np.array([j]))
            stale = True
            continue
        below = len(tree.levels[level - 1][0])
        i, j = np.divmod(np.arange(FAN * FAN), FAN)
        a2, b2 = (a[:, None] * FAN + i).ravel(), (b[:, None] * FAN + j).ravel()
        keep = (a2 < below) & (b2 < below) & (np.repeat(a != b, FAN * FAN) | (a2 <= b2))
        a2, b2 = a2[keep], b2[keep]
        # self pairs last on the stack, first off it: sets near each other join their components early
        own = a2 == b2
        if (~own).any():
            stack.append((level - 1, a2[~own], b2[~own]))
        if own.any():
            stack.append((level - 1, a2[own], b2[own]))
    return links.roots()
