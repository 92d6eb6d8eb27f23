"""JSON columns: tuples, keys of delete records, validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(text: Column, name: str, kind: str = "string") -> Column:
    """A top-level field; null where it is missing or not of the kind."""
    return F.get_json_object(text, f"$.{name}").try_cast(kind)


def delete_record(text: Column) -> Column:
    """struct(pk string, ts bigint) of ``{"pk": .., "ts": ..}``, or of a bare key, which has no ts."""
    whole = F.trim(text)
    is_object = whole.startswith("{")
    return F.struct(
        F.when(is_object, F.get_json_object(whole, "$.pk")).otherwise(whole).alias("pk"),
        F.when(is_object, F.get_json_object(whole, "$.ts").try_cast("bigint")).alias("ts"),
    )


def parse_key(text: Column) -> Column:
    """struct(pk bigint, ts bigint) as ``delete_record``; keys that are no integers are null."""
    record = delete_record(text)
    return F.struct(record["pk"].try_cast("bigint").alias("pk"), record["ts"].alias("ts"))


def valid(text: Column) -> Column:
    """Whether the text is JSON; null for null."""
    return F.when(text.isNotNull(), F.try_parse_json(text).isNotNull())


def extract(df, text: str, paths: dict[str, tuple[str, str]]):
    """``df`` with a column for each of ``paths`` (name -> (path, type)) of a JSON text, which is parsed once, to a variant;
    null where the text is no JSON, the path is missing or its value isn't of the type."""
    parsed = df.withColumn("_variant", F.try_parse_json(F.col(text)))
    return parsed.select(*df.columns, *[F.try_variant_get("_variant", path, kind).alias(name) for name, (path, kind) in paths.items()])


def variant_schema(df, text: str) -> str:
    """The schema that all JSON texts of a column have in common, by one aggregate over the parsed values."""
    return df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(text)))).first()[0]
