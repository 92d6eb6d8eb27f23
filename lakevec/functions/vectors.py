"""Codecs between logical vectors (arrays of floats, maps) and stored bytes, as Arrow functions over whole batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

_FLOATS = T.ArrayType(T.FloatType())


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a binary array, where each row begins (one entry more), and which rows are null."""
    v = values.cast(pa.large_binary())
    _, offsets, data = v.buffers()
    offsets = np.frombuffer(offsets, np.int64)[v.offset : v.offset + len(v) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0], np.array(v.is_null())


def _lists(values: np.ndarray, offsets: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values), mask=pa.array(null))


def _decoded(values: pa.Array, width: int, read) -> pa.Array:
    raw, offsets, null = _flat(values)
    if (np.diff(offsets) % width).any():
        raise ValueError(f"the length of a vector is no multiple of {width} bytes")
    return _lists(read(np.ascontiguousarray(raw)).astype(np.float32), offsets // width, null)


def _bfloat(raw: np.ndarray) -> np.ndarray:
    return (raw.view("<u2").astype(np.uint32) << 16).view(np.float32)


def to_bfloat(x: np.ndarray) -> np.ndarray:
    """Round to nearest, ties to even; NaN stays NaN."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    rounded = ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16).astype("<u2")
    return np.where(np.isnan(x), np.uint16(0x7FC0), rounded).astype("<u2")


def to_half(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return x.astype("<f2")


def to_half_truncated(x: np.ndarray) -> np.ndarray:
    """Big-endian half precision by cutting the mantissa: for readers of files that were written so."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    near = to_half(x)
    with np.errstate(over="ignore", invalid="ignore"):
        above = np.abs(near.astype(np.float32)) > np.abs(x)
    out = near.view(np.uint16) - (above & np.isfinite(x)).astype(np.uint16)
    out = np.where(np.isnan(x), np.uint16(0x7E00) | ((bits >> 16) & 0x8000).astype(np.uint16), out)
    return out.astype(">u2")


def _encoded(values: pa.Array, write) -> pa.Array:
    """Each list's bytes, all components written at once."""
    raw = write(values.flatten().to_numpy(zero_copy_only=False).astype(np.float32))
    sizes = np.nan_to_num(values.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)  # null: no bytes
    offsets = np.concatenate([[0], np.cumsum(sizes * raw.dtype.itemsize)]).astype(np.int64)
    known = pa.array(~np.array(values.is_null())).buffers()[1] if values.null_count else None
    made = pa.Array.from_buffers(pa.large_binary(), len(values), [known, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])
    return made.cast(pa.binary())


@arrow_udf(_FLOATS)
def floats_from_le(values: pa.Array) -> pa.Array:
    return _decoded(values, 4, lambda raw: raw.view("<f4"))


@arrow_udf(_FLOATS)
def floats_from_be(values: pa.Array) -> pa.Array:
    return _decoded(values, 4, lambda raw: raw.view(">f4"))


@arrow_udf(_FLOATS)
def floats_from_half(values: pa.Array) -> pa.Array:
    return _decoded(values, 2, lambda raw: raw.view("<f2"))


@arrow_udf(_FLOATS)
def floats_from_bfloat(values: pa.Array) -> pa.Array:
    return _decoded(values, 2, _bfloat)


@arrow_udf(T.BinaryType())
def floats_to_le(values: pa.Array) -> pa.Array:
    return _encoded(values, lambda x: x.astype("<f4"))


@arrow_udf(T.BinaryType())
def floats_to_be(values: pa.Array) -> pa.Array:
    return _encoded(values, lambda x: x.astype(">f4"))


@arrow_udf(T.BinaryType())
def floats_to_half(values: pa.Array) -> pa.Array:
    return _encoded(values, to_half)


@arrow_udf(T.BinaryType())
def floats_to_half_truncated(values: pa.Array) -> pa.Array:
    return _encoded(values, to_half_truncated)


@arrow_udf(T.BinaryType())
def floats_to_bfloat(values: pa.Array) -> pa.Array:
    return _encoded(values, to_bfloat)


@arrow_udf(T.BinaryType())
def long_to_le(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else v.to_bytes(8, "little", signed=True) for v in values.to_pylist()], pa.binary())


_ENTRY = np.dtype([("index", "<u4"), ("value", "<f4")])


@arrow_udf(T.MapType(T.LongType(), T.FloatType()))
def sparse_from_bytes(values: pa.Array) -> pa.Array:
    """(index u32, value f32) pairs, little-endian, to a map in the order of the indices."""
    out = []
    for v in values.to_pylist():
        pairs = None if v is None else np.sort(np.frombuffer(v, _ENTRY), order="index", kind="stable")
        out.append(None if v is None else list(dict(zip(pairs["index"].tolist(), pairs["value"].tolist(), strict=True)).items()))
    return pa.array(out, pa.map_(pa.int64(), pa.float32()))


@arrow_udf(T.BinaryType())
def sparse_to_bytes(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else np.array(sorted(v), _ENTRY).tobytes() for v in values.to_pylist()], pa.binary())


def sparse_from_json(text: Column) -> Column:
    """A JSON object of numbers by index to map<bigint, float>, sorted by index."""
    entries = F.array_sort(F.transform(F.map_entries(F.from_json(text, "map<string,float>")), lambda e: F.struct(e["key"].cast("bigint").alias("key"), e["value"].alias("value"))))
    return F.map_from_entries(entries)


def narrow(vector: Column) -> Column:
    """array<double> to array<float>."""
    return F.transform(vector, lambda x: x.cast("float"))


def packed_bits(text: Column, dim: int) -> Column:
    """A binary vector from text: the characters' bytes if they have ``dim`` bits, else base64."""
    return F.when(F.length(text) * 8 == dim, F.encode(text, "ISO-8859-1")).otherwise(F.unbase64(text))


def sign_bits(vector: Column) -> Column:
    """One bit per component, set where it is positive, the first one highest, as text of 0 and 1."""
    return F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), "")


def sign_bytes(vector: Column) -> Column:
    """The same bits, eight a byte; the last byte is filled up with zeros."""
    bits = F.rpad(sign_bits(vector), (F.ceil(F.size(vector) / 8) * 8).cast("int"), F.lit("0"))
    byte = lambda i: F.lpad(F.conv(F.substring(bits, i * 8 + 1, F.lit(8)), 2, 16), 2, "0")
    return F.when(F.size(vector) > 0, F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(F.size(vector) / 8).cast("int") - 1), byte), ""))).when(F.size(vector) == 0, F.lit(b""))
