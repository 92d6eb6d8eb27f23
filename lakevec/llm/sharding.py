"""Hierarchical weighted hash tree: rows descend region, rack and shard levels by weighted hash draws.

At each level every child ``c`` of weight ``w`` draws ``-ln(u(key, c)) / w`` with ``u`` a uniform hash of the key and
the child; the smallest draw wins. A child's draw depends on nothing but the key, its own name and its own weight, so
a change of one weight moves rows only into or out of the subtree whose weight changed; all other choices stand.

Everything is a DataFrame expression: the descent is evaluated in the scan's own stage and needs no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(n_shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """``n_shards`` equal shards: ``per_rack`` in a rack, ``racks`` in a region. Names are unique in the whole tree."""
    return [Leaf(i // (per_rack * racks), i // per_rack, i) for i in range(n_shards)]


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One shard more, as a region of its own.

    No weight of an older subtree changes, so rows move only into the new shard. (A shard put into an older rack
    would raise that rack's and region's weight, and newcomers to the region could then settle in its older shards.)
    """
    top = [max((getattr(x, k) for x in leaves), default=-1) + 1 for k in ("region", "rack", "shard")]
    return [*leaves, Leaf(*top, weight)]


def _draw(key: list[Column], level: str, node: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(f"{level}:{node}")), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _winner(key: list[Column], level: str, children: dict[int, float]) -> Column:
    draws = [
        F.struct(_draw(key, level, node, w).alias("draw"), F.lit(node).alias("node"))
        for node, w in sorted(children.items())
    ]
    return F.array_min(F.array(*draws))["node"] if len(draws) > 1 else F.lit(next(iter(children)))


def descend(key: list[Column], leaves: list[Leaf]) -> tuple[Column, Column, Column]:
    """Columns region, rack and shard for ``key``. Leaves of weight 0 (or less) take no rows."""
    leaves = [x for x in leaves if x.weight > 0]
    if not leaves:
        raise ValueError("no shard has a weight")
    if len({x.shard for x in leaves}) < len(leaves):
        raise ValueError("a shard is named twice")
    regions: dict[int, float] = defaultdict(float)
    racks: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[tuple[int, int], dict[int, float]] = defaultdict(dict)
    for x in leaves:
        regions[x.region] += x.weight
        racks[x.region][x.rack] += x.weight
        shards[x.region, x.rack][x.shard] = x.weight

    def case(options: list[tuple[Column, Column]]) -> Column:
        out = F.when(*options[0])
        for when, then in options[1:]:
            out = out.when(when, then)
        return out

    region = _winner(key, "region", regions)
    rack = case([(F.col("__tree_region") == r, _winner(key, "rack", kids)) for r, kids in racks.items()])
    shard = case([((F.col("__tree_region") == r) & (F.col("__tree_rack") == k), _winner(key, "shard", kids)) for (r, k), kids in shards.items()])
    return region, rack, shard


def place(df: DataFrame, key: list[str], leaves: list[Leaf], prefix: str = "") -> DataFrame:
    """Add ``{prefix}region``, ``{prefix}rack`` and ``{prefix}shard``. A null key is a key like any other."""
    region, rack, shard = descend([F.col(k) for k in key], leaves)
    return (
        df.withColumn("__tree_region", region)
        .withColumn("__tree_rack", rack)
        .withColumn("__tree_shard", shard)
        .withColumnsRenamed({"__tree_region": f"{prefix}region", "__tree_rack": f"{prefix}rack", "__tree_shard": f"{prefix}shard"})
    )


def shard_documents(docs: DataFrame, n_shards: int = 8, n_rows: int | None = None) -> DataFrame:
    """Every row of ``docs`` with its shard, its gapless place there, and its shard once one more shard exists.

    Law: ``key``, that is ``doc_id`` and the shard count alone decide. Needs ``doc_id`` and ``text``; other columns,
    whatever their names, are left alone. A null text counts no bytes and has CRC 0; a null doc_id is hashed as null
    and placed like any key; rows that share a doc_id share a shard but have slots of their own; an empty table gives
    an empty result. Only narrow rows (no text) are shuffled, to give out the slots.
    """
    n_rows = docs.count() if n_rows is None else n_rows
    leaves = topology(n_shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = place(rows, ["doc_id"], leaves)
    rows = place(rows, ["doc_id"], grown(leaves), "grown_").drop("grown_region", "grown_rack")
    rows = common.number_within(rows, ["shard"], ["doc_id"], "slot", n_rows)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")
