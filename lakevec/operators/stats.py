"""Summaries of columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: rows, values that aren't null, least and largest value as text. One pass over the table;
    where the source keeps such statistics and ``spark.sql.parquet.aggregatePushdown`` is on, the footers answer."""
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"l{i}"), F.max(c).cast("string").alias(f"h{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n{i}").alias("values"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max")) for i, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def percentiles(df: DataFrame, column: str, at: tuple[float, ...] = (0.25, 0.5, 0.75), exact: bool = True) -> DataFrame:
    """min, p25, p50, p75, max of a column. ``exact`` counts each distinct value; otherwise a bounded sketch is kept."""
    of = (lambda p: F.percentile(column, F.lit(p))) if exact else (lambda p: F.approx_percentile(column, F.lit(p), F.lit(10_000)))
    return df.agg(F.min(column).alias("min"), *[of(p).alias(f"p{round(100 * p)}") for p in at], F.max(column).alias("max"))


def sample(df: DataFrame, ratio: float, seed: int = 1) -> DataFrame:
    """A Bernoulli sample; a ratio over 0.99 is everything."""
    if ratio <= 0:
        raise ValueError("the ratio must be over 0")
    return df if ratio > 0.99 else df.sample(False, ratio, seed)


@F.pandas_udf(T.DoubleType())
def geometric_mean(values: pd.Series) -> float:
    """A user-defined aggregate over Arrow batches: the values of one group, which are narrow, come to one task."""
    return float(np.exp(np.log(values).mean()))
