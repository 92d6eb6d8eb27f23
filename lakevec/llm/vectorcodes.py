"""Vector code compression: product codes whose distances come from per-dimension value dictionaries.

A vector's components become integers floor(256 * x), and the vector is cut into PARTS equal consecutive parts. Each part
position has its own codebook of at most ENTRIES entries. It starts as the parts of the vectors with the smallest ids;
in each of ROUNDS rounds every part goes to its nearest entry (squared Euclidean distance, ties to the lower index) and
every entry becomes the componentwise floor of its parts' mean. Everything is integer arithmetic, so that results don't
depend on how rows are dealt.

A component takes few different values. For every dimension of a batch its distinct integers are the dictionary, the
squared differences of each of them to that dimension's component of all entries are tabulated once, and the distances
of all parts are gathers from these tables by dictionary code, added up over the part's dimensions. A batch's tables are
no larger than its rows, whatever values there are.

Codebooks are PARTS * ENTRIES short vectors, so they are broadcast; a task gives sums and counts per entry, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Larger integers could make sums of squared differences leave 64 bits.
LARGEST = 1 << 27
#: Rows whose distances a task holds at once.
ROWS = 8192
#: Labels with more than this part of all rows are joined by a broadcast; there are no more of them than that.
HEAVY = 1000


def components(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(vec_id, x: array<bigint>, label) of the rows that take part, and their dimension, the most frequent length."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    rows = rows.where(F.col("v").isNotNull()).where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    if dim % PARTS:
        raise ValueError(f"vectors of {dim} components can't be cut into {PARTS} equal parts")
    whole = lambda x: F.when(F.abs(x) * SCALE < LARGEST, F.floor(x * SCALE)).otherwise(F.raise_error(F.lit("a component is too large for 64-bit distances")).cast("long"))
    return rows.where(F.size("v") == dim).select("vec_id", F.transform("v", whole).alias("x"), "label"), dim


class Dictionary:
    """The distinct integers of one dimension of a batch, and each row's place among them."""

    def __init__(self, column: np.ndarray):
        low = int(column.min(initial=0))
        span = int(column.max(initial=0)) - low + 1
        if span <= 4 * len(column):  # a dense range: a place for each integer that occurs, without sorting
            seen = np.zeros(span, bool)
            seen[column - low] = True
            self.values = np.flatnonzero(seen) + low
            self.codes = (np.cumsum(seen) - 1)[column - low]
        else:
            self.values, self.codes = np.unique(column, return_inverse=True)

    def squares(self, entries: np.ndarray) -> np.ndarray:
        """Squared differences of every distinct integer (rows) to every entry's component (columns)."""
        return (self.values[:, None] - entries[None, :]) ** 2


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances) of the rows' parts, both rows * parts, for ``books`` (parts, entries, width)."""
    n, (parts, _, width) = len(x), books.shape
    codes, errors = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
    for p in range(parts):
        total = None
        for j in range(width):
            words = Dictionary(x[:, p * width + j])
            found = words.squares(books[p, :, j])[words.codes]
            total = found if total is None else np.add(total, found, out=total)
        if total is not None:
            codes[:, p] = total.argmin(1)
            errors[:, p] = np.take_along_axis(total, codes[:, p, None], 1)[:, 0]
    return codes, errors


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim)


_SUMS = "part int, entry int, n long, sums array<bigint>"


def _counted(shared, dim: int):
    """A task's count and componentwise sum for every entry that some part is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, entries, width = books.shape
        n, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for _, x in _matrices(batches, dim):
            at = (nearest(x, books)[0] + np.arange(parts) * entries).ravel()
            n += np.bincount(at, minlength=len(n))
            np.add.at(sums, at, x.reshape(-1, width))
        used = np.flatnonzero(n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used // entries, pa.int32()), pa.array(used % entries, pa.int32()), pa.array(n[used]), lists], names=["part", "entry", "n", "sums"])

    return run


def train(rows: DataFrame, dim: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts, entries, width); fewer entries where there are fewer rows."""
    spark, width = rows.sparkSession, dim // PARTS
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").toArrow()  # ``entries`` rows
    start = np.array(first.column("x").to_pylist(), np.int64).reshape(len(first), PARTS, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if books.size else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = rows.mapInArrow(_counted(shared, dim), _SUMS).groupBy("part", "entry")
        added = sums.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums")).toArrow()  # a row for each entry
        shared.destroy()
        books = books.copy()
        part, entry, n = (added.column(c).to_numpy() for c in ("part", "entry", "n"))
        books[part, entry] = np.array(added.column("sums").to_pylist(), np.int64).reshape(-1, width) // n[:, None]
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (bytes: an index for each part) and error of every row."""
    parts, _, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, parts * width):
            codes, errors = nearest(x, shared.value)
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(x), [None, pa.py_buffer(codes.astype(np.uint8).tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), raw.cast(pa.binary()), pa.array(errors.sum(1))], names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]))


def decode(coded: DataFrame, books: np.ndarray, code_col: str = "code") -> DataFrame:
    """``coded`` with ``vector``: the entries that a row's code names, as components (the middle of their integers)."""
    parts, _, width = books.shape
    shared = coded.sparkSession.sparkContext.broadcast(books)
    out = T.StructType([*coded.schema.fields, T.StructField("vector", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(code_col).to_pylist()), np.uint8).reshape(-1, parts)
            x = ((shared.value[np.arange(parts), codes] + 0.5) / SCALE).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * parts * width, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "vector"])

    return coded.mapInArrow(run, out)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels (nulls together). Labels of more than a thousandth
    of the rows, of which there are fewer than a thousand, are joined where their rows are; the rest by a shuffle."""
    sums = common.materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")), "labels")
    total = sums.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    heavy, light = (sums.where(x).select(F.col("label").alias("_label"), "label_error") for x in (F.col("_n") > total // HEAVY, F.col("_n") <= total // HEAVY))
    same = F.col("label").eqNullSafe(F.col("_label"))
    often = coded.join(F.broadcast(heavy), same)
    seldom = coded.join(F.broadcast(heavy), same, "left_anti").join(light, same)
    return often.unionByName(seldom).drop("_label")


def compress_table(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code (two hex digits for each part), error, label_error and codebooks_sha256 of every vector.

    Rows whose vector is null or holds a null or non-finite component take no part, nor do vectors that aren't of the
    table's most frequent length (of equally frequent ones the smallest). Rows without an id come after all others when
    codebooks start; rows that repeat an id are rows of their own, ordered by their components. Equal vectors get equal
    codes. An empty table gives an empty result. ValueError if the length can't be cut into 16 parts; components of
    2**19 and more raise, as their distances don't fit 64 bits. Other columns are left out, whatever their names.
    """
    rows, dim = components(table, id_col, vector_col, label_col)
    books = train(rows, dim)
    if not books.size:
        return table.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = common.materialise(encode(rows, books), "codes")
    out = with_label_errors(coded)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


_KEPT = f"""k AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64 AND list_count(embedding) = 64 AND NOT list_contains(list_transform(embedding, lambda x: isfinite(x)), false)),
  v AS (SELECT n, vec_id, label, p, x[4 * p + 1] AS a, x[4 * p + 2] AS b, x[4 * p + 3] AS c, x[4 * p + 4] AS d FROM k, range({PARTS}) r(p)),
  b0 AS (SELECT p, n - 1 AS e, a, b, c, d FROM v WHERE n <= {ENTRIES})"""


def _assigned(name: str, books: str) -> str:
    d = " + ".join(f"(v.{c} - w.{c}) * (v.{c} - w.{c})" for c in "abcd")
    return f"""{name} AS (SELECT v.n, v.p, min({{'d': {d}, 'e': w.e}}) AS m FROM v JOIN {books} w ON v.p = w.p GROUP BY v.n, v.p)"""


def _moved(name: str, assigned: str, books: str) -> str:
    means = ", ".join(f"CAST(floor(sum(v.{c}) / count(*)) AS BIGINT) AS {c}" for c in "abcd")
    held = ", ".join(f"coalesce(m.{c}, w.{c}) AS {c}" for c in "abcd")
    return f"""{name} AS (SELECT w.p, w.e, {held} FROM {books} w LEFT JOIN (SELECT v.p, s.m.e AS e, {means} FROM v JOIN {assigned} s ON v.n = s.n AND v.p = s.p GROUP BY ALL) m ON m.p = w.p AND m.e = w.e)"""


ORACLE_SQL = f"""WITH {_KEPT}, {_assigned('s0', 'b0')}, {_moved('b1', 's0', 'b0')}, {_assigned('s1', 'b1')}, {_moved('b2', 's1', 'b1')}, {_assigned('s2', 'b2')},
  h AS (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2),
  f AS (SELECT k.vec_id, k.label, k.n, string_agg(lower(format('{{:02x}}', s.m.e)), '' ORDER BY s.p) AS code, CAST(sum(s.m.d) AS BIGINT) AS error FROM s2 s JOIN k ON s.n = k.n GROUP BY ALL)
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f, h"""
