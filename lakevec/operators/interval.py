"""Interval join: each point with the intervals of its keys that hold it, as an equi-join over adaptive bins.

The axis is cut at quantiles of the points, so that bins hold equally many of them. An interval is copied into every bin
that it meets; a point is in one bin, so no pair comes twice. How many bins there are follows from the intervals: the most
for which copies stay within a stated multiple of the input, counted in one pass for all candidates. A key's points in one
bin may still be most of all; such heavy bins are dealt over parts, into each of which their intervals are copied.

Where only aggregates of a point's intervals are wanted, ``interval_aggregate`` makes no pairs: points are numbered, an
interval becomes the few blocks of numbers (of sizes 1, 2, 4, ...) that it is made of, and a point looks up its blocks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import scan

#: Bins that are tried, and copies of intervals that are made at most, as a multiple of all rows.
BINS, COPIES = (2, 8, 32, 128, 512), 2.0
#: Points of a key and bin that one task may get; more are dealt over parts. No fewer than a HEAVIEST-th of all points, so
#: that the table of heavy bins, which is broadcast, has no more rows than that.
POINTS, HEAVIEST = 200_000, 10_000
#: Aggregates of intervals, and how those of parts are put together.
FOLDS = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
#: Points are looked up in blocks of at most 2 ** BLOCK_BITS; larger ones are cut into such.
BLOCK_BITS = 12


def _chosen(cuts: list, n: int) -> list:
    """At most n - 1 of the cuts, evenly."""
    return sorted({cuts[len(cuts) * i // n] for i in range(1, n)}) if cuts else []


def _bin(value: Column, cuts: list) -> Column:
    """How many of the sorted ``cuts`` are not above ``value``: binary search over one literal array."""
    if not cuts:
        return F.lit(0)
    array, widths = F.array(*[F.lit(c) for c in cuts]), [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]

    def step(at: Column, width: Column) -> Column:
        to = at + width
        return F.when((to <= len(cuts)) & (F.try_element_at(array, to) <= value), to).otherwise(at)

    return F.aggregate(F.array(*[F.lit(w) for w in widths]), F.lit(0), step)


def _cuts(points: DataFrame, at: str, most: int) -> list:
    """Distinct quantiles of the points, at most ``most`` - 1, from a bounded sketch."""
    found = points.agg(F.percentile_approx(at, [i / most for i in range(1, most)], 20 * most)).first()[0] or []
    return sorted(set(found))


def _axis(points: DataFrame, at: str):
    """A function that makes whole numbers of dates and times."""
    kind = points.schema[at].dataType.simpleString()
    return {"timestamp": F.unix_micros, "timestamp_ntz": lambda c: F.unix_micros(c.cast("timestamp")), "date": F.unix_date}.get(kind, lambda c: c)


def interval_join(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, by: list[str] | None = None, how: str = "inner", bins: int | None = None, most_points: int = POINTS
) -> DataFrame:
    """Rows of ``points`` with rows of ``intervals`` for which ``start <= at < end`` and all of ``by`` are equal.

    The columns are those of ``points``, then those of ``intervals`` but ``by``; names may not clash otherwise. ``how`` is
    "inner" or "left" (points that no interval holds stay, with nulls). ``at``, ``start`` and ``end`` are of one numeric,
    date or timestamp type. Null keys and bounds match nothing; an interval that ends where it starts, or before, is empty.
    ``bins`` sets the number of bins, which otherwise follows from the data.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"no interval join of kind {how}")
    by, others = by or [], [c for c in intervals.columns if c not in (by or [])]
    clash = set(others) & set(points.columns)
    if clash:
        raise ValueError(f"both sides have a column {sorted(clash)[0]}")
    turn = _axis(points, at)
    usable = reduce(and_, [F.col(c).isNotNull() for c in (*by, start, end)], F.col(start) < F.col(end))
    left = points.withColumns({"_at": turn(F.col(at)), "_row": F.monotonically_increasing_id()})
    right = intervals.where(usable).withColumns({"_from": turn(F.col(start)), "_to": turn(F.col(end))})

    cuts = _cuts(left, "_at", max(2, bins or max(BINS)))
    n_points = left.agg(F.count("*")).first()[0]
    if bins is None:
        divisions = [_chosen(cuts, n) for n in BINS]
        met = [F.sum(_bin(F.col("_to"), c) - _bin(F.col("_from"), c) + 1).alias(f"c{i}") for i, c in enumerate(divisions)]
        copies = right.agg(F.count("*").alias("n"), *met).first()
        fits = [c for i, c in enumerate(divisions) if (copies[f"c{i}"] or 0) <= COPIES * (n_points + copies["n"])]
        cuts = fits[-1] if fits else divisions[0]
    # the optimizer carries equalities with an expression that has a lambda to the other side of a join, where its columns
    # aren't; it leaves out what may differ from run to run, so a number that is always 0 is added
    left = left.withColumn("_bin", _bin(F.col("_at"), cuts) + F.spark_partition_id() * 0)
    right = right.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_from"), cuts), _bin(F.col("_to"), cuts))))

    # heavy bins: a row each, of which there are at most HEAVIEST, counted once for both sides
    limit = max(most_points, n_points // HEAVIEST)
    heavy = left.groupBy(*by, "_bin").count().where(F.col("count") > limit)
    heavy = heavy.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_bin").alias("_heavy"), F.ceil(F.col("count") / limit).cast("int").alias("_parts"))
    parts = F.broadcast(points.sparkSession.createDataFrame(heavy.collect(), heavy.schema))
    same = lambda: reduce(and_, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(by)], F.col("_bin") == F.col("_heavy"))
    keys = [f"_k{i}" for i in range(len(by))] + ["_heavy", "_parts"]
    n_parts = F.coalesce("_parts", F.lit(1))
    left = left.join(parts, same(), "left").withColumn("_part", F.pmod("_row", n_parts).cast("int")).drop(*keys)
    right = right.join(parts, same(), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n_parts - 1))).drop(*keys)

    a, b = left.alias("a"), right.alias("b")
    on = reduce(and_, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*by, "_bin", "_part")], (F.col("b._from") <= F.col("a._at")) & (F.col("a._at") < F.col("b._to")))
    return a.join(b, on, how).select(*[F.col(f"a.`{c}`") for c in points.columns], *[F.col(f"b.`{c}`") for c in others])


def _blocks(a: Column, b: Column) -> Column:
    """The (size as a power of 2, place) of the aligned blocks that the numbers from ``a`` to ``b`` - 1 are made of: two of a size at most."""

    def of_size(k: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        low, high = F.call_function("shiftright", a + one - 1, k), F.call_function("shiftright", b, k)
        block = lambda test, place: F.when((low < high) & test, F.struct(k.alias("k"), place.alias("i")))
        return F.array(block(low % 2 == 1, low), block(high % 2 == 1, high - 1))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.length(F.bin(b - a)) - 1), of_size)), lambda x: x.isNotNull())


def interval_aggregate(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, aggs: dict[str, tuple[str, str]], by: list[str] | None = None, bits: int = BLOCK_BITS
) -> DataFrame:
    """``points`` with aggregates of the intervals of ``interval_join``, without points that no interval holds.

    ``aggs`` has kind ("count", "sum", "min" or "max") and column ("*" to count) by name. The work grows with points and
    intervals, by a factor of their logarithm, and not with the pairs: distinct points are numbered in their key by a
    segmented scan, equal intervals are one, blocks of equal size and place are one. No task gets more than the points of
    a block for a block, or a key as a whole; points of one place are looked up once and joined by that place.
    """
    by = by or []
    clash = set(aggs) & set(points.columns)
    if clash:
        raise ValueError(f"there is a column {sorted(clash)[0]} already")
    if wrong := [kind for kind, _ in aggs.values() if kind not in FOLDS]:
        raise ValueError(f"no aggregate of kind {wrong[0]}")
    turn, keys = _axis(points, at), [f"_k{i}" for i in range(len(by) or 1)]
    own = [F.col(c).alias(k) for c, k in zip(by, keys, strict=False)] or [F.lit(0).alias("_k0")]
    names = [f"_a{i}" for i in range(len(aggs))]
    fold = [FOLDS[kind](n).alias(n) for n, (kind, _) in zip(names, aggs.values(), strict=True)]
    places = points.where(reduce(and_, [F.col(c).isNotNull() for c in (*by, at)])).select(*own, turn(F.col(at)).alias("_x")).distinct()
    usable = reduce(and_, [F.col(c).isNotNull() for c in (*by, start, end)], F.col(start) < F.col(end))
    values = [(F.lit(1) if c == "*" else F.col(c)).alias(n) for n, (_, c) in zip(names, aggs.values(), strict=True)]
    ranges = intervals.where(usable).select(*own, turn(F.col(start)).alias("_from"), turn(F.col(end)).alias("_to"), *values)
    ranges = ranges.groupBy(*keys, "_from", "_to").agg(*[getattr(F, kind)(n).alias(n) for n, (kind, _) in zip(names, aggs.values(), strict=True)])

    # in the order of a key's points and ends of intervals, an end before a point of its place: how many points came before
    ends = ranges.select(*keys, F.explode(F.array("_from", "_to")).alias("_x"), F.lit(0).alias("_is"), "_from", "_to", *names)
    ranked = scan(places.withColumn("_is", F.lit(1)).unionByName(ends, allowMissingColumns=True), keys, "_x", "_is", ["_is"])
    numbered = ranked.where("_is = 1").select(*keys, "_x", (F.col("running_sum") - 1).alias("_r"))
    spans = ranked.where("_is = 0").groupBy(*keys, "_from", "_to").agg(F.min("running_sum").alias("_a"), F.max("running_sum").alias("_b"), *[F.any_value(n).alias(n) for n in names]).where("_a < _b")

    made = spans.select(*keys, *names, F.explode(_blocks(F.col("_a"), F.col("_b"))).alias("_n")).groupBy(*keys, "_n.k", "_n.i").agg(*fold)
    over = F.greatest(F.col("k") - bits, F.lit(0))
    cut = F.explode(F.sequence(F.call_function("shiftleft", F.col("i"), over), F.call_function("shiftleft", F.col("i") + 1, over) - 1))
    small = made.select(*keys, F.least("k", F.lit(bits)).alias("_k"), cut.alias("_i"), *names).groupBy(*keys, "_k", "_i").agg(*fold)
    asked = numbered.select(*keys, "_x", "_r", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("_k")).withColumn("_i", F.call_function("shiftright", "_r", F.col("_k")))
    found = asked.join(small, [*keys, "_k", "_i"]).groupBy(*keys, "_x").agg(*fold)
    rows = points.withColumns({"_y": turn(F.col(at)), **{f"_y{i}": F.col(c) for i, c in enumerate(by)}})
    same = reduce(and_, [F.col(f"_y{i}") == F.col(f"_k{i}") for i in range(len(by))], F.col("_y") == F.col("_x"))
    return rows.join(found, same).select(*points.columns, *[F.col(n).alias(name) for n, name in zip(names, aggs, strict=True)])
