"""JSON rows: one per line, or all of a file's rows wrapped as ``{"rows": [...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str | None = None, wrapped: bool = True, sampling: float = 1.0) -> DataFrame:
    """``wrapped`` files are read whole, one per task; lines are split. Without a schema one is inferred from a sample."""
    if not 0 < sampling <= 1:
        raise ValueError("the sampling ratio is over 0 and up to 1")
    reader = spark.read.option("samplingRatio", sampling)
    if not wrapped:
        return (reader.schema(schema) if schema else reader).json(path)
    if schema is not None:
        inner = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([T.StructField("rows", T.ArrayType(inner))]))
    return reader.option("multiLine", "true").json(path).select(F.explode("rows").alias("r")).select("r.*")
