"""Distances between vectors, in double precision, as expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("L2", "IP", "COSINE", "HAMMING")


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_l2(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(squared_l2(a, b))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(inner_product(a, b), norm(a) * norm(b))


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two texts of 0 and 1 (``hamming_bytes`` has binary values)."""
    bits = lambda v: F.split(v, "")
    return F.size(F.filter(F.arrays_zip(bits(a).alias("x"), bits(b).alias("y")), lambda p: p["x"] != p["y"]))


#: Hexadecimal digits that are counted at once, as a number of 60 bits.
_DIGITS = 15


def hamming_bytes(a: Column, b: Column) -> Column:
    """Differing bits of two binary values of one length; null for values of two lengths."""
    count = lambda v: F.ceil(F.octet_length(v) * 2 / _DIGITS).cast("int")
    words = lambda v: F.when(F.octet_length(v) > 0, F.transform(F.sequence(F.lit(0), count(v) - 1), lambda i: F.conv(F.substring(F.hex(v), i * _DIGITS + 1, F.lit(_DIGITS)), 16, 10).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    differing = F.aggregate(F.zip_with(words(a), words(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(F.octet_length(a) == F.octet_length(b), differing)


def sparse_inner_product(a: Column, b: Column) -> Column:
    """Over the indices that both maps have."""
    shared = F.array_sort(F.array_intersect(F.map_keys(a), F.map_keys(b)))
    return F.aggregate(shared, F.lit(0.0), lambda s, k: s + F.element_at(a, k).cast("double") * F.element_at(b, k).cast("double"))


def score(metric: str, a: Column, b: Column) -> Column:
    of = {"L2": l2, "IP": inner_product, "COSINE": cosine, "HAMMING": hamming_bytes}
    if metric.upper() not in of:
        raise ValueError(f"unknown metric {metric}")
    return of[metric.upper()](a, b)


def nearer_is_larger(metric: str) -> bool:
    return metric.upper() in ("IP", "COSINE")
