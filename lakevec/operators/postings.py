"""Posting lists of sparse vectors: for every shard and index the rows that have it, with the extremes of each block.

A shard's rows are numbered so that rows with the same heaviest index are neighbours, and cut into blocks. What a block's
rows can score at most follows from the extremes of its lists; blocks are visited from the most promising on, until none
left can reach the k-th score found. Inside the visited blocks lists come from the most to the least weighty, and rows that
cannot reach it any more are dropped on the way. Shards are searched by themselves and their rows merged.

That looks at the fewest entries, but one query at a time. Many queries are asked together: blocks are put into tiles, and
those of a portion's queries that a tile's extremes let reach their k-th score meet its rows in one product, a matrix of the
lists that most rows are in, and entry by entry of all others. Scores of the rows found are summed again in the order of
indices in either way, so equal vectors have equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import storage

#: Rows of a shard and of a block; blocks that are visited at once, few at first, as they set what others must reach.
SHARD_ROWS, BLOCK, FIRST, TOGETHER = 50_000, 8, 8, 128
LISTS = "shard int, index long, n long, ids binary, rows binary, values binary, blocks binary, highest binary, lowest binary"
FOUND = "query_id long, id long, score double, touched long, held long"
#: Bytes of queries that are broadcast at once.
QUERY_BYTES = 32 << 20
#: More queries than MANY are asked together, in portions of so many queries and about so many entries; rows of a tile.
MANY, PORTION, PORTION_ENTRIES, TILE = 32, 256, 1 << 14, 1024
#: A list is in the matrix if it has one of so many rows. Rows found that are kept before they are summed again, and terms of
#: such sums at once.
DENSE, POOL, TERMS = 16, 100_000, 1 << 20


def _shard(shard: int, ids: np.ndarray, row: np.ndarray, index: np.ndarray, value: np.ndarray) -> pa.Table:
    """The lists of some rows (ids); entries are (row, index, value)."""
    heaviest = np.full(len(ids), -1, np.int64)
    by = np.lexsort((index, np.abs(value), row))
    last = np.flatnonzero(np.append(np.diff(row[by]) > 0, True)) if len(by) else by
    heaviest[row[by[last]]] = index[by[last]]
    weight = np.zeros(len(ids))
    weight[row[by[last]]] = np.abs(value[by[last]])
    order = np.lexsort((ids, -weight, heaviest))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    ids, row = ids[order], place[row]
    by = np.lexsort((row, index))
    row, index, value = row[by], index[by], value[by]
    names, start = np.unique(index, return_index=True)
    out = []
    for name, a, b in zip(names.tolist(), start.tolist(), [*start[1:].tolist(), len(index)], strict=True):
        blocks, first = np.unique(row[a:b] // BLOCK, return_index=True)
        dump = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
        high, low = np.maximum.reduceat(value[a:b], first), np.minimum.reduceat(value[a:b], first)
        out.append((shard, name, len(ids), dump(ids, "<i8") if not out else None, dump(row[a:b], "<i4"), dump(value[a:b], "<f8"), dump(np.stack([blocks, first]), "<i4"), dump(high, "<f8"), dump(low, "<f8")))
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
    return pa.table({n: pa.array([o[i] for o in out], k) for i, (n, k) in enumerate(zip(("shard", "index", "n", "ids", "rows", "values", "blocks", "highest", "lowest"), kinds, strict=True))})


def build(rows: DataFrame, path: str, id_col: str = "id", vector_col: str = "vector", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """LISTS of ``rows`` (maps from index to value), stored at ``path`` and sorted by index within a shard. Rows without an
    id or entries, and values that are null or not finite, aren't in it; the ids of a shard's rows are with its first list."""
    usable = rows.select(F.col(id_col).cast("long").alias("id"), F.map_filter(vector_col, lambda _, v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).alias("v")).where("id IS NOT NULL AND size(v) > 0")
    shards = max(1, -(-usable.count() // shard_rows))
    dealt = usable.select(F.pmod(F.xxhash64("id", F.lit("postings")), F.lit(shards)).cast("int").alias("shard"), "id", F.map_keys("v").alias("keys"), F.map_values("v").alias("values"))

    def make(key, table):
        keys, values = (table.column(c).combine_chunks() for c in ("keys", "values"))
        row = np.repeat(np.arange(len(table)), np.asarray(keys.value_lengths()))
        return _shard(key[0].as_py(), table.column("id").to_numpy(), row, keys.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(float))

    dealt.groupBy("shard").applyInArrow(make, LISTS).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(LISTS).parquet(path)


def _bounds(lists: list, weights: np.ndarray, n_blocks: int) -> np.ndarray:
    """(list, block) the most that a list adds to a row of the block."""
    out = np.zeros((len(lists), n_blocks))
    for t, (one, w) in enumerate(zip(lists, weights, strict=True)):
        out[t, one["blocks"]] = np.maximum(w * (one["highest"] if w > 0 else one["lowest"]), 0)
    return out


def _nearest(ids: np.ndarray, lists: list, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(ids, scores) of the ``k`` best rows of a shard, entries that were looked at, and entries of all lists."""
    held = sum(len(one["rows"]) for one in lists)
    n_blocks = -(-len(ids) // BLOCK)
    most = _bounds(lists, weights, n_blocks)
    total = most.sum(0)
    present = np.zeros(n_blocks, bool)
    for one in lists:
        present[one["blocks"]] = True
    order = np.argsort(-total, kind="stable")
    order = order[present[order]]
    best_ids, best, touched = np.zeros(0, np.int64), np.zeros(0), 0
    where = np.full((len(lists), n_blocks), -1, np.int64)
    for t, one in enumerate(lists):
        where[t, one["blocks"]] = np.arange(len(one["blocks"]))
    slot = np.empty(n_blocks, np.int64)
    i, size = 0, FIRST
    while i < len(order):
        some = order[i : i + size]
        i, size = i + size, min(TOGETHER, size * 3 // 2)
        least = best[-1] if len(best) == k else -np.inf
        slack = 1e-12 * (1 + abs(least)) if np.isfinite(least) else 0  # what the order of a sum may do
        some = some[total[some] >= least - slack]
        if not len(some):
            break
        slot[some] = np.arange(len(some))
        score, seen, rest = np.zeros((len(some), BLOCK)), np.zeros((len(some), BLOCK), bool), total[some].copy()
        alive = some[:, None] * BLOCK + np.arange(BLOCK) < len(ids)
        for t in np.argsort(-most[:, some].sum(1), kind="stable").tolist():
            one, has = lists[t], np.flatnonzero(where[t, some] >= 0)
            alive &= score + rest[:, None] >= least - slack
            has = has[alive[has].any(1)]
            if len(has):
                at = where[t, some[has]]
                begin, end = one["first"][at].astype(np.int64), np.append(one["first"], len(one["rows"]))[at + 1].astype(np.int64)
                n = end - begin
                entry = np.repeat(begin - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                row = one["rows"][entry].astype(np.int64)
                r, c = slot[row // BLOCK], row % BLOCK
                mine = alive[r, c]
                touched += int(mine.sum())
                score[r[mine], c[mine]] += weights[t] * one["values"][entry[mine]]
                seen[r[mine], c[mine]] = True
            rest -= most[t, some]
        r, c = np.nonzero(alive & seen & (score >= least - slack))
        rows = some[r] * BLOCK + c
        best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, _summed(lists, weights, rows)])
        top = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[top], best[top]
    return best_ids, best, touched, held


def _summed(lists: list, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The scores of some rows, added in the order of the lists."""
    out = np.zeros(len(rows))
    if len(rows):
        for one, w in zip(lists, weights, strict=True):
            at = np.minimum(np.searchsorted(one["rows"], rows), len(one["rows"]) - 1)
            has = one["rows"][at] == rows
            out[has] += w * one["values"][at[has]]
    return out


def _spread(begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each ``begin`` on, ``n`` of them, and which of the ranges each is of."""
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + begin[of], of


def _needless(ids: np.ndarray, of: np.ndarray, rows: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Whether a row equals ``k`` rows of smaller ids in all entries: it is never among the ``k`` best. Rows are compared by
    128 bits of their entries."""
    digests = np.zeros((2, len(ids)), np.uint64)
    by = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(rows[by]) > 0)) if len(by) else by
    for digest, seed in zip(digests, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), strict=True):
        x = (of[by].astype(np.uint64) + np.uint64(1)) * np.uint64(seed)
        for part in (np.ascontiguousarray(values[by]).view(np.uint64), np.uint64(seed)):
            x = (x ^ part) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(32)
        if len(by):
            digest[rows[by[first]]] = np.add.reduceat(x, first)
    order = np.lexsort((ids, *digests))
    new = np.append(True, (np.diff(digests[:, order]) != 0).any(0))
    place = np.arange(len(ids)) - np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    out = np.empty(len(ids), bool)
    out[order] = place >= k
    return out


class _Tiles:
    """A shard's lists, one behind another by index, with the entries of each list and tile and their extremes."""

    def __init__(self, ids: np.ndarray, lists: list, k: int):
        self.ids, self.n = ids, -(-len(ids) // TILE)
        self.held = np.array([len(one["rows"]) for one in lists], np.int64)
        of = np.repeat(np.arange(len(lists)), self.held)
        self.rows = np.concatenate([one["rows"] for one in lists]).astype(np.int64)
        self.values = np.concatenate([one["values"] for one in lists])
        stay = ~_needless(ids, of, self.rows, self.values, k)[self.rows]
        of, self.rows, self.values = of[stay], self.rows[stay], self.values[stay]
        sizes = np.bincount(of, minlength=len(lists))  # of equal rows some stay, so no list is without entries
        self.keys = of * len(ids) + self.rows
        both = of * self.n + self.rows // TILE
        self.begin = np.flatnonzero(np.append(True, np.diff(both) > 0))
        self.count = np.diff(np.append(self.begin, len(both)))
        self.tile, self.list_tiles = both[self.begin] % self.n, np.searchsorted(both[self.begin], np.arange(len(lists) + 1) * self.n)
        self.high, self.low = np.maximum.reduceat(self.values, self.begin), np.minimum.reduceat(self.values, self.begin)
        self.largest = np.maximum.reduceat(np.abs(self.values), np.cumsum(sizes) - sizes)
        # the matrix: entries of its lists by row
        self.dense = sizes * DENSE >= len(ids)
        self.column = np.cumsum(self.dense) - 1
        mine = np.flatnonzero(self.dense[of])
        mine = mine[np.argsort(self.rows[mine], kind="stable")]
        self.d_row, self.d_column, self.d_value = self.rows[mine], self.column[of[mine]], self.values[mine]
        self.d_tile = np.searchsorted(self.d_row, np.arange(self.n + 1) * TILE)

    def matrix(self, tile: int, there: bool) -> np.ndarray:
        """(column, row) the tile's values, or where there are any."""
        at = slice(self.d_tile[tile], self.d_tile[tile + 1])
        out = np.zeros((int(self.dense.sum()), min(TILE, len(self.ids) - tile * TILE)), np.float32 if there else float)
        out[self.d_column[at], self.d_row[at] - tile * TILE] = 1 if there else self.d_value[at]
        return out


def _together(tiles: _Tiles, query: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the ``k`` best rows of the shard for ``n`` queries of entries (query, list, weight), and by query
    the entries that were looked at and those of all its lists."""
    by = np.lexsort((query, of))
    query, of, weight = query[by], of[by], weight[by]
    terms = np.bincount(query, minlength=n)
    # what the order of a sum may do
    slack = 4 * np.finfo(float).eps * (terms + 8) * np.bincount(query, np.abs(weight) * tiles.largest[of], n) + np.finfo(float).tiny
    at, e = _spread(tiles.list_tiles[of], np.diff(tiles.list_tiles)[of])
    cell = query[e] * tiles.n + tiles.tile[at]
    most = np.bincount(cell, np.maximum(np.maximum(weight[e] * tiles.high[at], weight[e] * tiles.low[at]), 0), n * tiles.n).reshape(n, tiles.n) + slack[:, None]
    entries = np.bincount(cell, tiles.count[at], n * tiles.n).reshape(n, tiles.n).astype(np.int64)
    touched = np.zeros(n, np.int64)
    # entries outside of the matrix, by tile
    light = np.flatnonzero(~tiles.dense[of[e]])
    light = light[np.argsort(tiles.tile[at[light]], kind="stable")]
    l_at, l_query, l_weight = at[light], query[e[light]], weight[e[light]]
    l_tile = np.searchsorted(tiles.tile[l_at], np.arange(tiles.n + 1))
    heavy = np.flatnonzero(tiles.dense[of])
    asked = np.zeros((n, int(tiles.dense.sum())))
    asked[query[heavy], tiles.column[of[heavy]]] = weight[heavy]

    top, least = np.full((n, k), -np.inf), np.full(n, -np.inf)  # least: what a row's sum must reach to be among the k best
    pool, pooled, step = [], 0, max(1, TERMS // max(1, int(terms.max())))  # (query, row, its sum)

    def settle() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        q, row, about = (np.concatenate(x) for x in zip(*pool, strict=True)) if pool else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        stay = np.flatnonzero(about >= least[q])
        stay = stay[np.argsort(q[stay], kind="stable")]
        q, row, about = q[stay], row[stay], about[stay]
        score = np.concatenate([_pair_sums(tiles, query, of, weight, n, q[i : i + step], row[i : i + step]) for i in range(0, len(q), step)] or [np.zeros(0)])
        order = np.lexsort((tiles.ids[row], -score, q))
        q, row, about, score = q[order], row[order], about[order], score[order]
        first = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[first], row[first], about[first], score[first]

    for tile in np.argsort(-most.sum(0), kind="stable").tolist():
        mine = np.flatnonzero((entries[:, tile] > 0) & (most[:, tile] >= least))
        if not len(mine):
            continue
        touched[mine] += entries[mine, tile]
        x = tiles.matrix(tile, False)
        width = x.shape[1]
        score = asked[mine] @ x
        place = np.full(n, -1)
        place[mine] = np.arange(len(mine))
        l = slice(l_tile[tile], l_tile[tile + 1])
        some = np.flatnonzero(place[l_query[l]] >= 0) + l.start
        entry, j = _spread(tiles.begin[l_at[some]], tiles.count[l_at[some]])
        flat = place[l_query[some]][j] * width + tiles.rows[entry] - tile * TILE
        if len(flat):
            score += np.bincount(flat, l_weight[some][j] * tiles.values[entry], score.size).reshape(score.shape)
        unsure = np.flatnonzero(least[mine] <= 0)  # rows that share no index have a sum of 0 here, but aren't found
        if len(unsure):
            seen = (asked[mine[unsure]] != 0).astype(np.float32) @ tiles.matrix(tile, True) > 0
            if len(flat):
                seen |= np.bincount(flat, minlength=score.size).reshape(score.shape)[unsure] > 0
            score[unsure] = np.where(seen, score[unsure], -np.inf)
        found = np.flatnonzero((score >= least[mine, None]).any(1) & (score > -np.inf).any(1))
        if not len(found):
            continue
        q, score = mine[found], score[found]
        best = np.partition(score, width - k, axis=1)[:, width - k :] if width > k else score
        best = np.concatenate([top[q], best], axis=1)
        top[q] = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k :]
        least[q] = top[q].min(1) - 2 * slack[q]
        r, c = np.nonzero((score >= least[q, None]) & (score > -np.inf))
        pool.append((q[r], tile * TILE + c, score[r, c]))
        pooled += len(r)
        if pooled > 4 * k * n + POOL:
            pool = [settle()[:3]]
            pooled = len(pool[0][0])
    q, row, _, score = settle()
    return q, tiles.ids[row], score, touched, np.bincount(query, tiles.held[of], n).astype(np.int64)


def _pair_sums(tiles: _Tiles, query: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, q: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The scores of pairs of a query and a row, by query, added in the order of the lists, which that of the entries is."""
    first = np.searchsorted(q, np.arange(n + 1))
    pair, e = _spread(first[query], np.diff(first)[query])
    key = of[e] * len(tiles.ids) + row[pair]
    at = np.minimum(np.searchsorted(tiles.keys, key), len(tiles.keys) - 1)
    has = np.flatnonzero(tiles.keys[at] == key)
    return np.bincount(pair[has], weight[e[has]] * tiles.values[at[has]], len(q))


def _portions(start: np.ndarray):
    """(from, to) of the queries that are asked together; query i has the entries from start[i] on."""
    a, n = 0, len(start) - 1
    while a < n:
        b = max(a + 1, min(a + PORTION, int(np.searchsorted(start, start[a] + PORTION_ENTRIES, "right")) - 1))
        yield a, b
        a = b


_FOUND = (("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64()), ("touched", pa.int64()), ("held", pa.int64()))


def _found(q, i, score, touched=None, held=None) -> pa.Table:
    none = [0] * len(q)
    return pa.table([pa.array(x, t) for x, (_, t) in zip((q, i, score, none if touched is None else touched, none if held is None else held), _FOUND, strict=True)], names=[n for n, _ in _FOUND])


def _searcher(shared, k: int):
    """A function from a shard's lists to what they have for the broadcast queries."""

    def run(table):
        ids, known = np.zeros(0, np.int64), {}
        for r in table.to_pylist():
            if r["ids"] is not None:
                ids = np.frombuffer(r["ids"], "<i8")
            blocks_, first = np.frombuffer(r["blocks"], "<i4").reshape(2, -1)
            known[r["index"]] = {"rows": np.frombuffer(r["rows"], "<i4"), "values": np.frombuffer(r["values"], "<f8"), "blocks": blocks_, "first": first, "highest": np.frombuffer(r["highest"], "<f8"), "lowest": np.frombuffer(r["lowest"], "<f8")}
        queries, start, index, weight = shared.value  # the entries of a query by index
        lists = [known[i] for i in sorted(known)]
        names = np.array(sorted(known), np.int64)
        at = np.minimum(np.searchsorted(names, index), max(0, len(names) - 1))
        has = names[at] == index if len(names) else np.zeros(len(index), bool)
        out = []
        if len(queries) <= MANY or not has.any():
            for i, q in enumerate(queries.tolist()):
                mine = np.arange(start[i], start[i + 1])[has[start[i] : start[i + 1]]]
                got, score, touched, held = _nearest(ids, [lists[j] for j in at[mine]], weight[mine], k)
                out += [_found([q] * len(got), got, score), _found([q], [None], [None], [touched], [held])]
            return pa.concat_tables(out) if out else _found([], [], [])
        tiles = _Tiles(ids, lists, k)
        for a, b in _portions(start):
            part = slice(start[a], start[b])
            mine = np.flatnonzero(has[part]) + part.start
            q = np.searchsorted(start, mine, "right") - 1 - a
            q, got, score, touched, held = _together(tiles, q, at[mine], weight[mine], b - a, k)
            out += [_found(queries[a:b][q], got, score), _found(queries[a:b], [None] * (b - a), [None] * (b - a), touched, held)]
        return pa.concat_tables(out)

    return run


def search(lists: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "query_id", vector_col: str = "vector") -> DataFrame:
    """query_id, rank, id, score, touched and held of the ``k`` rows with the largest inner product with each query (maps from
    index to value). Rows that share no index with a query aren't found; ties go to the smaller id. ``touched`` and ``held``
    are the entries of the query's lists that were looked at, and all of them, over all shards."""
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.map_filter(vector_col, lambda _, v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) & (v != 0)).alias("v")).where("query_id IS NOT NULL AND size(v) > 0")
    size = asked.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0] * 16
    blocks, found = max(1, -(-size // QUERY_BYTES)), None
    shards = (lists.agg(F.max("shard")).first()[0] or 0) + 1  # a shard is one task's work, whatever its bytes
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        part = mine.select("query_id", F.array_sort(F.map_entries("v")).alias("v")).select("query_id", F.col("v.key").alias("index"), F.col("v.value").alias("weight")).toArrow().combine_chunks()  # about QUERY_BYTES
        index, weight = (part.column(c).combine_chunks() for c in ("index", "weight"))
        start = np.append(0, np.cumsum(index.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)))
        index = index.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        shared = lists.sparkSession.sparkContext.broadcast((part.column("query_id").to_numpy(), start, index, weight.flatten().to_numpy(zero_copy_only=False).astype(float)))
        wanted = np.unique(index).tolist()
        # only the lists of the queries' indices are read, and each shard's ids
        mine = lists.where(F.col("index").isin(wanted) | F.col("ids").isNotNull()) if len(wanted) <= 10_000 else lists
        here = storage.materialise(mine.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(_searcher(shared, k), FOUND), "postings-found")
        found = here if found is None else found.unionByName(here)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.where("id IS NOT NULL").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    looked = found.groupBy("query_id").agg(F.sum("touched").alias("touched"), F.sum("held").alias("held"))
    return ranked.drop("touched", "held").join(looked, "query_id").select("query_id", "rank", "id", "score", "touched", "held")
