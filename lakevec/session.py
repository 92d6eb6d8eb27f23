"""A local session with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "lakevec", cores: str = "*", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
