"""Exact dedup by content sort: sampled splitters, external sort, comparison of neighbours.

1. A sample of the rows, sorted by the bytes of their normalised texts, gives splitters: of the neighbours near a quantile
   those that differ soonest, and of the later one as many characters as tell it from the one before it. So a splitter
   orders whole texts by their bytes and is still short.
2. Texts that fill a quarter of a range or more in the sample have ranges of their own, over which their ids deal
   them, so that ranges hold about equally many rows even where one text fills a third of the table.
3. Each row goes to its range with its whole text; inside a range Spark's external sort puts equal texts next to each
   other, and every normalised text is compared in full with the one before it.
4. Only groups of such frequent texts lie in more than one range. Of these, whose number the number of ranges bounds, one
   text from each range is compared in full again, and the parts are put together.

DataFrame functions only; the text is shuffled once and nothing but narrow rows after that.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Ranges for each shuffle partition (hashing several ranges into a partition evens its size out), up to so many ranges
#: in all; from there on a range for each partition.
RANGES_PER_PARTITION, RANGES = 6, 12_000
#: Sampled rows for each range.
SAMPLED_PER_RANGE = 24
_LAST = (1 << 63) - 1


def _shared(a: Column, b: Column) -> Column:
    """How many characters two texts begin with alike."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(30))])
    same = lambda n: a.substr(F.lit(1), n) == b.substr(F.lit(1), n)
    whole = F.least(F.length(a), F.length(b))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= whole) & same(at + step), at + step).otherwise(at))


def _cuts(hashes: list[int], shared: list[int], ranges: int) -> tuple[list[int], dict[int, int]]:
    """Of a sorted sample (hash of each text, characters shared with the one before): the places of the splitters, and
    the hashes of frequent texts with how many ranges each has."""
    step = len(hashes) / ranges
    frequent = {h: min(n, ceil(n / step)) for h, n in Counter(hashes).items() if n > 1 and 4 * n >= step}
    rest = [i for i, h in enumerate(hashes) if h not in frequent]
    places = set()
    for k in range(1, ceil(len(rest) / step) if rest else 0):
        near = range(max(1, int((k - 0.25) * step)), min(len(rest) - 1, int((k + 0.25) * step)) + 1)
        fresh = [(shared[rest[j]], rest[j]) for j in near if hashes[rest[j]] != hashes[rest[j - 1]]]
        if fresh:
            places.add(min(fresh)[1])
    return sorted(places), frequent


def _splitters(rows: DataFrame, ranges: int, n_rows: int) -> tuple[list[str], list[tuple[int, int, int]]]:
    """Splitters in order, and (hash, first range, ranges) of each frequent text by hash."""
    fraction = min(1.0, ranges * SAMPLED_PER_RANGE / max(1, n_rows))
    order = Window.orderBy("_norm")  # over the sample: ranges * SAMPLED_PER_RANGE texts, not more for more data
    # sampled before anything is computed
    seen = rows.sample(fraction, seed=8).select(common.squeezed(F.col("_text")).alias("_norm"))
    seen = seen.select("_norm", F.row_number().over(order).alias("_at"), F.lag("_norm", 1, "").over(order).alias("_before"))
    # the one task only sorts: neighbours are compared in many
    seen = seen.repartition("_at").withColumn("_shared", _shared(F.col("_norm"), F.col("_before")))
    start = F.when(F.col("_norm") != F.col("_before"), F.col("_norm").substr(F.lit(1), F.col("_shared") + 1))
    seen = common.materialise(seen.select("_at", F.xxhash64("_norm").alias("_hash"), "_shared", start.alias("_start")), "sample")
    narrow = sorted(tuple(r) for r in seen.select("_at", "_hash", "_shared").collect())
    places, frequent = _cuts([r[1] for r in narrow], [r[2] for r in narrow], ranges) if narrow else ([], {})
    cuts = sorted(r[0] for r in seen.where(F.col("_at").isin([narrow[i][0] for i in places])).select("_start").collect()) if places else []
    own, first = [], len(cuts) + 1
    for h, parts in sorted(frequent.items()):
        own.append((h, first, parts))
        first += parts
    return cuts, own


def _at_or_below(entries: list, x: Column) -> Column:
    """How many of the sorted ``entries`` are at or below ``x``, by halving."""
    if not entries:
        return F.lit(0)
    n, array = len(entries), F.array(*[F.lit(e) for e in entries])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    reached = lambda at: F.element_at(array, F.least(at, F.lit(n))) <= x
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & reached(at + step), at + step).otherwise(at))


def _dealt(rows: DataFrame, norm: Column, cuts: list[str], own: list[tuple[int, int, int]]) -> DataFrame:
    """``rows`` with _key, _range, and _cut: whether the row's group may lie in more than one range."""
    kept = rows.columns
    rows = rows.withColumn("_n", norm).withColumn("_key", F.coalesce(F.col("_id"), F.lit(_LAST)))
    if not own:
        return rows.select(*kept, "_key", F.lit(False).alias("_cut"), _at_or_below(cuts, F.col("_n")).alias("_range"))
    rows = rows.withColumn("_hash", F.xxhash64("_n"))
    rows = rows.withColumn("_own", F.greatest(_at_or_below([h for h, _, _ in own], F.col("_hash")), F.lit(1)))
    of = lambda i: F.element_at(F.array(*[F.lit(x[i]) for x in own]), F.col("_own"))
    frequent = of(0) == F.col("_hash")
    mine = (of(1) + F.pmod(F.xxhash64("_key"), of(2))).cast("int")
    return rows.select(
        *kept, "_key", (frequent & (of(2) > 1)).alias("_cut"), F.when(frequent, mine).otherwise(_at_or_below(cuts, F.col("_n"))).alias("_range")
    )


def _sorted(rows: DataFrame, n_rows: int, tie: Column, normal: bool) -> DataFrame:
    """``rows`` (_id, _text, others) with _key, _cut, _first, _range, _group, _keep, _size and _norm (of rows that are the
    first of a part of a group of a frequent text). ``normal``: the normalised text is shuffled, else the text."""
    shuffle = common.shuffle_partitions(rows.sparkSession)
    cuts, own = _splitters(rows, max(1, shuffle, min(RANGES_PER_PARTITION * shuffle, RANGES)), n_rows)
    norm = common.squeezed(F.col("_text"))
    if normal:
        rows, norm = rows.withColumn("_text", norm), F.col("_text")
    rows = _dealt(rows, norm, cuts, own)
    rows = rows.repartition("_range").withColumn("_norm", norm)
    sort = Window.partitionBy("_range").orderBy("_norm", "_key", tie)
    so_far = sort.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_first", ~F.col("_norm").eqNullSafe(F.lag("_norm").over(sort))).withColumn("_at", F.row_number().over(sort))
    rows = rows.withColumn("_group", F.last(F.when(F.col("_first"), F.col("_at")), ignorenulls=True).over(so_far))
    return rows.drop("_at")


def _whole(rows: DataFrame) -> DataFrame:
    """Of groups that lie in several ranges: _range, _group, and the smallest key and size of the whole. Not more rows than
    the frequent texts have ranges (a few for each shuffle partition): small for any input."""
    same = Window.partitionBy("_norm")
    parts = rows.where("_cut AND _first").select("_range", "_group", F.min("_keep").over(same).alias("_all_keep"), F.sum("_size").over(same).alias("_all_size"))
    return F.broadcast(parts)


def group_equal_texts(docs: DataFrame, n_rows: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (all of the normalised text).

    Texts are equal when they are identical after every run of white space became one space. A null text is the
    empty text. The smallest doc_id of a group is its keep_id. Null doc_ids come last: they stay only where no row of
    the group has an id, and keep_id is then null. Rows that repeat a doc_id and text are members like others; one of
    them is kept. Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = _sorted(rows, docs.count() if n_rows is None else n_rows, F.lit(0), normal=True)
    rows = rows.select("_id", "_key", "_cut", "_range", "_first", "_group", F.when(F.col("_cut") & F.col("_first"), F.col("_norm")).alias("_norm"), F.sha2("_norm", 256).alias("text_sha256"))
    group = Window.partitionBy("_range", "_group")
    rows = rows.withColumn("_keep", F.min("_key").over(group)).withColumn("_size", F.count("*").over(group))
    rows = common.materialise(rows, "sorted")
    rows = rows.join(_whole(rows), ["_range", "_group"], "left")
    keep = F.coalesce("_all_keep", "_keep")
    return rows.select(
        F.col("_id").alias("doc_id"),
        F.nullif(keep, F.lit(_LAST)).alias("keep_id"),
        F.coalesce("_all_size", "_size").cast("long").alias("group_size"),
        (F.col("_first") & (F.col("_keep") == keep) & (F.col("_key") == keep)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a row with a smaller doc_id has; of rows that repeat doc_id and text, one stays:
    that of the smallest hash over all its columns.

    Null and empty texts equal each other. Rows without a doc_id stay only where no row with their text has one, and
    then one of them. All columns come through, whatever their names; an empty table stays empty. Rows go through the
    content sort whole, so the text is shuffled once.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    hashed = [F.col(f"_row.c{i}") for i, f in enumerate(docs.schema) if "map<" not in f.dataType.simpleString()]
    at = docs.columns.index("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"), row.alias("_row"))
    # the text goes once: in the row it is put back afterwards
    kind = docs.schema["text"].dataType
    rows = rows.withColumn("_tie", F.xxhash64(*hashed)).withColumn("_row", F.col("_row").withField(f"c{at}", F.lit(None).cast(kind)))
    rows = _sorted(rows, docs.count(), F.col("_tie"), normal=False)
    group = F.when(F.col("_cut"), F.col("_norm"))
    # within a range the first row of a group has its smallest key
    rows = rows.where("_first").select("_row", "_text", "_range", "_group", "_cut", "_first", F.col("_key").alias("_keep"), F.lit(1).alias("_size"), "_tie", group.alias("_norm"))
    rows = common.materialise(rows, "sorted")
    mine = F.struct("_keep", "_tie", "_range")
    least = rows.where("_cut").select("_range", "_group", F.min(mine).over(Window.partitionBy("_norm")).alias("_least"))
    rows = rows.join(F.broadcast(least), ["_range", "_group"], "left")  # as few rows as _whole has
    rows = rows.where(F.col("_least").isNull() | (F.col("_least") == mine))
    return rows.select(*[(F.col("_text").cast(kind) if i == at else F.col(f"_row.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size, sha256(norm) AS text_sha256 FROM n GROUP BY norm
)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, n.doc_id = g.keep_id AS kept, g.text_sha256
FROM n JOIN g USING (norm)
"""
