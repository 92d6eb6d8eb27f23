"""Functions that SQL text can call: bodies in SQL, and a table function that shapes its result by its input."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn  # noqa: F401
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType, TimestampType

#: name -> (parameters, type, body): inlined by the optimizer, so they cost what their bodies do.
BODIES = {
    "unit_price": ("price DOUBLE, discount DOUBLE, quantity DOUBLE", "DOUBLE", "CASE WHEN quantity <> 0 THEN price * (1 - discount) / quantity END"),
    "half_open": ("at TIMESTAMP, opened TIMESTAMP, closed TIMESTAMP", "BOOLEAN", "at >= opened AND at < closed"),
    "key_shard": ("key STRING, shards INT", "INT", "CAST(pmod(crc32(key), shards) AS INT)"),
}


class SessionsOf:
    """``sessions_of(TABLE(rows), key => 'user_id', ts => 'ts', gap => 3600)``: all columns of the rows and the number of the
    session, from 1 on, within a key; a session ends where the next row comes ``gap`` seconds later or more. Rows are dealt by
    the key and sorted by the time for it; one row is held at a time. Rows without a time are in session 0."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, ts: AnalyzeArgument, gap: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument is a table")
        names = rows.dataType.fieldNames()
        for given in (key.value, ts.value):
            if given not in names:
                raise ValueError(f"there is no column {given}")
        if not isinstance(rows.dataType[ts.value].dataType, TimestampType | TimestampNTZType):
            raise ValueError(f"{ts.value} is no timestamp")
        schema = StructType([*rows.dataType.fields, StructField("session", LongType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(ts.value)])

    def __init__(self):
        self.last, self.session = None, 0

    def eval(self, rows: Row, key: str, ts: str, gap: int) -> Iterator[tuple]:
        at = rows[ts]
        if at is None:
            yield (*rows, 0)
            return
        if self.last is None or (at - self.last).total_seconds() >= gap:
            self.session += 1
        self.last = at
        yield (*rows, self.session)


def register(spark: SparkSession) -> None:
    """Make all of them known to the session's SQL."""
    from pyspark.sql.functions import udtf

    for name, (parameters, kind, body) in BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("sessions_of", udtf(SessionsOf))
