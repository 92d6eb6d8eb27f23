"""N-gram Jaccard join: documents linked by the Jaccard similarity of their word shingles, by signature trees.

1. Each text becomes a set of shingle hashes. Equal sets are one class, of which the smallest doc_id goes on.
2. Minimum hashes in BANDS bands of ROWS deal classes to neighbourhoods: classes that share a band are in one. Two sets
   at the threshold share no band with a chance of (1 - s ** ROWS) ** BANDS, 3e-10 for s = 0.75, less above it; this
   is of the size of what 64-bit hashes themselves can get wrong. (Beginnings of the sets under one order of all
   shingles, which lose nothing at all, were tried: as no table of bounded size tells a shingle of two documents from
   one of ten, passages that few documents share join most sets to one neighbourhood.)
3. Neighbourhoods are connected components over the bands, so each set is shipped once, to one task, which finds
   its links by a dual traversal of a signature tree (see ``signature_tree``), exactly.
4. A neighbourhood over BLOCK sets is dealt to blocks. Two rounds over blocks alone, dealt in different ways, join most
   of it; then each set outside the largest component so far meets the blocks that hold one of its bands, by trees
   again. No task has more than two blocks.

Components, not pairs, come out, so a group of copies costs its size, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, signature_tree
from .batches import map_texts
from .components import connected_components
from .shingles import mix, shingle_sets

WORDS, NUM, DEN = 5, 75, 100
BANDS, ROWS = 40, 3
#: What a task takes at once, of one neighbourhood or of small ones dealt to one group: a set counts 1, and 1 more for
#: each SHINGLES of its shingles, so that very long texts make smaller blocks.
BLOCK, SHINGLES = 1000, 1000
#: Groups for each block's worth of sets, so that hashing the tasks to groups evens out.
GROUPS = 4
#: Bits of the filter that keeps texts without neighbours from being shuffled (16 MB).
FILTER_BITS = 1 << 27
_FACTORS = np.random.default_rng(66).integers(1, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 4096
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def bands_of(tokens: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: ROWS minima under different hash functions, mixed with the band's number."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(tokens), _CHUNK):
        np.minimum(least, (tokens[None, i : i + _CHUNK] * _FACTORS[:, None]).min(1), out=least)
    key = mix(np.arange(BANDS, dtype=np.uint64))
    for row in least.reshape(ROWS, BANDS):
        key = mix(key ^ row)
    return key


def _sketcher(words: int):
    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle_sets(part.column("text"), words)
            digests = np.array([[mix(s, 1).sum(dtype=np.uint64), mix(s, 2).sum(dtype=np.uint64)] for s in sets], np.uint64).reshape(len(sets), 2).view(np.int64)
            keys = [bands_of(s).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            bands = pa.ListArray.from_arrays(np.cumsum([0, *map(len, keys)]).astype(np.int32), np.concatenate(keys) if keys else np.zeros(0, np.int64))
            columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), bands]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

        return step

    return map_texts(make)


def _linker(words: int, num: int, den: int):
    """Rows (task, doc_id, label, side, text) of some tasks: within each task, the new component of each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        task, doc_id, label, side = (table.column(c).to_numpy() for c in ("task", "doc_id", "label", "side"))
        sets = shingle_sets(table.column("text").combine_chunks(), words)
        order = np.argsort(task, kind="stable")
        starts = np.flatnonzero(np.r_[True, task[order][1:] != task[order][:-1]]) if len(order) else []
        out = [[], []]
        for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
            at = order[a:b]
            roots = signature_tree.link([sets[i] for i in at], num, den, label[at], None if (side[at] == 3).all() else side[at])
            labels = label[at]
            least = np.full(len(at), np.iinfo(np.int64).max)
            np.minimum.at(least, roots, labels)
            out[0].append(labels)
            out[1].append(least[roots])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch one entry (band, class) for each band, that of its smallest class, and an edge from each other class
    to that one: however many rows share a band, few leave the batch."""
    for batch in batches:
        bands = batch.column("bands")
        band = bands.flatten().to_numpy()
        node = np.repeat(batch.column("set_a").to_numpy(), bands.value_lengths().to_numpy())
        yield _grouped(band, node, entries=True)


def _grouped(band: np.ndarray, node: np.ndarray, entries: bool) -> pa.RecordBatch:
    order = np.lexsort((node, band))
    band, node = band[order], node[order]
    fresh = np.r_[True, band[1:] != band[:-1]] if len(band) else np.zeros(0, bool)
    least = node[np.maximum.accumulate(np.where(fresh, np.arange(len(node)), 0))] if len(node) else node
    a, b = node[node != least], least[node != least]
    if len(a):
        a, b = np.unique(np.stack([a, b], 1), axis=0).T
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    if not entries:
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])
    band, node = band[fresh], node[fresh]
    columns = [pa.concat_arrays([x, pa.array(y, pa.int64())]) for x, y in zip(columns, (node, node), strict=True)]
    bands = pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(band, pa.int64())])
    return pa.RecordBatch.from_arrays([bands, *columns], names=["band", "a", "b"])


def _near(rows: DataFrame) -> DataFrame:
    """Edges (a, b) between classes that share a band, from rows (set_a, bands); the bands are shuffled once."""
    spark = rows.sparkSession
    out = rows.mapInArrow(_local, "band long, a long, b long")
    groups = max(common.shuffle_partitions(spark), 1)
    out = out.repartition(groups, F.coalesce("band", "a"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, nodes = [], []
        for batch in batches:
            entry = batch.column("band").is_valid()
            yield batch.filter(pc.invert(entry)).select(["a", "b"])
            entries = batch.filter(entry)
            bands.append(entries.column("band").to_numpy())
            nodes.append(entries.column("a").to_numpy())
        if bands:
            yield _grouped(np.concatenate(bands), np.concatenate(nodes), entries=False)

    return out.mapInArrow(across, "a long, b long")


def _perhaps(texts: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """``texts`` without most of the rows that ``members`` (doc_id) doesn't name, so that they need no shuffle.

    A filter of 16 bits for a member, but no more than FILTER_BITS: with more members it lets more through, which costs
    time and changes nothing, for a join with ``members`` follows.
    """
    bits = min(FILTER_BITS, 1 << max(10, (16 * n).bit_length()))
    bit = F.pmod(F.xxhash64("doc_id", F.lit("filter")), F.lit(bits))
    words = members.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
    found = words.toArrow()  # FILTER_BITS / 64 rows at most
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            at = batch.column("_bit").fill_null(0).to_numpy()
            hit = (known[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(hit == 1)).select(["doc_id", "text"])

    return texts.withColumn("_bit", bit).mapInArrow(test, "doc_id long, text string")


def _linked(members: DataFrame, texts: DataFrame, groups: int, linker) -> DataFrame:
    """Edges (label, label) from ``members`` (doc_id, label, task, side), each task whole in one of ``groups``."""
    # members grow with the data: they are never broadcast
    rows = members.hint("merge").join(texts, "doc_id").withColumn("_group", F.pmod(F.xxhash64("task"), F.lit(max(1, GROUPS * groups))))
    return rows.groupBy("_group").applyInArrow(_as_group(linker), "a long, b long").distinct()


def _as_group(linker):
    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(linker(iter(table.to_batches())))

    return run


def link_documents(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (reads ``doc_id`` and ``text``).

    Two documents are linked when num / den of the union of their shingles is shared; component_id is the smallest
    doc_id reachable by links, the document's own included. Texts without words, and nulls, have no shingles and link
    with nothing. Rows that repeat a doc_id are one document with the links of all of them. A row without a doc_id
    links with nothing and has no component_id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = common.materialise(texts.mapInArrow(_sketcher(words), SKETCH), "sketches")
    live = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # 1. classes of equal sets; 2. neighbourhoods: classes (by the first half of their digest) that share a band
    classes = live.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("class_id"), F.max("n_shingles").alias("size"))
    classes = common.materialise(classes, "classes")
    near = connected_components(_near(live.select("set_a", "bands")))
    near = near.withColumnsRenamed({"node": "set_a", "component": "task"}).join(classes, "set_a")
    near = near.select(F.col("class_id").alias("doc_id"), "task", (1 + F.floor(F.col("size") / SHINGLES)).alias("weight"))
    near = common.materialise(near, "near")
    sizes = near.groupBy("task").agg(F.sum("weight").alias("n"), F.count("*").alias("members")).persist()
    total = lambda c, where=F.lit(True): F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0))
    n_near, n_weight, n_large = sizes.agg(total("members"), total("n"), total("n", F.col("n") > block)).first()
    linker = _linker(words, num, den)
    whole = _perhaps(texts.where("text IS NOT NULL"), near, int(n_near))
    both = F.lit(3).alias("side")
    # 3. neighbourhoods that one task can take
    small = near.join(sizes.where(F.col("n") <= block).select("task"), "task").select("doc_id", F.col("doc_id").alias("label"), "task", both)
    edges = common.materialise(_linked(small, whole, -(-int(n_weight) // block), linker), "links")
    # 4. the larger ones
    if n_large:
        large = near.join(sizes.where(F.col("n") > block), "task").select("doc_id", F.col("task").alias("hood"), "n", "weight")
        large = common.materialise(large.hint("merge").join(whole, "doc_id"), "large")
        edges = edges.unionByName(_link_large(large, live.select("doc_id", "bands"), int(n_large), block, linker))
    sizes.unpersist()
    # an id in several rows is one document: its classes are linked
    again = common.materialise(sketches.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "again")
    some = again.head(1)
    if some:
        own = live.join(again, "doc_id").join(classes, ["set_a", "set_b"]).select("doc_id", "class_id").distinct()
        least = own.groupBy("doc_id").agg(F.min("class_id").alias("b"))
        edges = edges.unionByName(own.join(least, "doc_id").where("class_id <> b").select(F.col("class_id").alias("a"), "b"))
    found = connected_components(edges).withColumnsRenamed({"node": "class_id", "component": "component_id"})
    member = classes.join(found, "class_id", "left").select("set_a", "set_b", F.coalesce("component_id", "class_id").alias("component_id"))
    out = sketches.select("doc_id", "n_shingles", "set_a", "set_b").join(member, ["set_a", "set_b"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    if some:  # also for the rows of such an id that have no words
        least = out.join(again, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("least"))
        out = out.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))
    return out


def _link_large(large: DataFrame, bands: DataFrame, rows: int, block: int, linker) -> DataFrame:
    """Edges of the neighbourhoods ``large`` (doc_id, hood, n, weight, text) that weigh more than ``block``; ``bands``
    (doc_id, bands) are those of all sets."""
    texts = large.select("doc_id", "text")
    labels = large.select("doc_id", "hood", "n", "weight", F.col("doc_id").alias("label"))
    part = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.expr(f"cast(ceil(n / {block}) AS bigint)"))
    edges = None
    for salt in (1, 2):
        members = labels.select("doc_id", "label", F.xxhash64("hood", part(salt)).alias("task"), F.lit(3).alias("side"))
        new = common.materialise(_linked(members, texts, -(-rows // block), linker), "links")
        edges = new if edges is None else edges.unionByName(new)
        # labels are ids of members, so each member finds its own component: no key is met by many rows
        found = connected_components(edges).withColumnsRenamed({"node": "doc_id", "component": "now"})
        labels = labels.join(found, "doc_id", "left").select("doc_id", "hood", "n", "weight", F.coalesce("now", "doc_id").alias("label"))
        labels = common.materialise(labels, "labels")
    counts = labels.groupBy("hood", "label").agg(F.count("*").alias("k"))
    main = counts.groupBy("hood").agg(F.max_by("label", F.struct("k", F.negative("label"))).alias("main"), F.count("*").alias("kinds"))
    labels = labels.join(main.where("kinds > 1").select("hood", "main"), "hood").withColumn("part", part(3))
    rest = labels.where("label <> main")
    # a set outside the largest component meets the parts that hold one of its bands; such sets have parts of their
    # own besides
    n_rest = rest.groupBy("hood").agg(F.sum("weight").alias("r"))
    rest = rest.join(n_rest, "hood").withColumn("_rest", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.expr(f"cast(ceil(r / {block}) AS bigint)")))
    rest = common.materialise(rest.select("doc_id", "hood", "label", "weight", "_rest"), "rest")
    banded = lambda df, *also: df.join(bands, "doc_id").select(*also, F.explode("bands").alias("band")).distinct()
    holds = banded(labels.join(n_rest.select("hood"), "hood", "left_semi"), "hood", "part")
    meet = banded(rest, "doc_id", "hood", "label", "weight", "_rest").join(holds, ["hood", "band"])
    meet = common.materialise(meet.select("doc_id", "hood", "label", "weight", "_rest", "part").distinct(), "meet")
    one = meet.select("doc_id", "label", "weight", F.xxhash64("hood", "_rest", "part").alias("task"), F.lit(1).alias("s"))
    other = labels.join(meet.select("hood", "_rest", "part").distinct(), ["hood", "part"])
    other = other.select("doc_id", "label", "weight", F.xxhash64("hood", "_rest", "part").alias("task"), F.lit(2).alias("s"))
    pairs = one.unionByName(other).groupBy("doc_id", "label", "weight", "task").agg(F.sum("s").cast("int").alias("side"))
    n = pairs.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    last = common.materialise(_linked(pairs.drop("weight"), texts, -(-n // block), linker), "links") if n else None
    return edges.unionByName(last) if last is not None else edges


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest doc_id of each component and without the others.

    Null and empty texts are linked with nothing and stay, as do rows without a doc_id. Rows that repeat a doc_id are
    one document: they stay or go together. All columns come through, whatever their names; an empty table stays empty.
    """
    gone = link_documents(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
