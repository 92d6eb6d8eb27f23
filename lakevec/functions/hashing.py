"""Hashes of primary keys and the shards that they give; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spark's ``hash`` begins with seed 42; this integer is the one whose hash is 0, so what follows it is hashed with seed 0.
_SEED_ZERO = -1693959553
#: Characters of a string key that are hashed.
HASHED_CHARS = 100


def hash_int64(key: Column) -> Column:
    """Murmur3 (32 bits, seed 0) of a 64-bit integer, without the sign bit, as a long. Null for null."""
    return F.when(key.isNotNull(), F.hash(F.lit(_SEED_ZERO).cast("int"), key.cast("long")).bitwiseAND(0x7FFFFFFF).cast("long"))


def hash_string(key: Column) -> Column:
    """CRC-32 of the UTF-8 bytes of the first characters, as a long."""
    return F.crc32(F.encode(F.substring(key.cast("string"), 1, HASHED_CHARS), "UTF-8"))


def shard_of_int64(key: Column, shards: int) -> Column:
    return F.pmod(hash_int64(key), F.lit(shards))


def shard_of_string(key: Column, shards: int) -> Column:
    return F.pmod(hash_string(key), F.lit(shards))
