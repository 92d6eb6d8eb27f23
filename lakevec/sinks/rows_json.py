"""Wrapped JSON rows: each file is ``{"rows": [ ... ]}`` with a row per line."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_rows(df: DataFrame, path: str, mode: str = "errorifexists", ignore_null_fields: bool = True, pretty: bool = False, compression: str = "none") -> None:
    """One file for each partition of ``df``; a partition without rows is a file without rows, which is valid too."""
    options = {"ignoreNullFields": str(ignore_null_fields).lower(), "pretty": str(pretty).lower()}
    lines = df.select(F.to_json(F.struct("*"), options).alias("value"))

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = '{"rows":['
        for batch in batches:
            values = batch.column("value").to_pylist()
            if not values:
                continue
            out = [head + "\n" + values[0] if head else "," + values[0], *("," + v for v in values[1:])]
            head = ""
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array([head + "]}"], pa.string())], names=["value"])

    lines.mapInArrow(wrap, "value string").write.mode(mode).option("compression", compression).text(path)
