"""Plumbing shared by the corpus operators: shared scratch tables, numbering, reading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one numbering bucket should hold.
ROWS_PER_BUCKET = 10_000
#: The white space that the text contracts name: space and the bytes 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]"


class _Made(threading.local):
    """The scratch paths of each thread, oldest first."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A table's scan over all cores: where its files hold fewer row groups than there are cores (small tables, or few
    and huge row groups), the rows are dealt anew, since the text operators' work per row outweighs moving it once."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``).

    Only where that setting is missing in a local session, as in tests, a temporary folder of this machine is made and
    removed at exit; ValueError on a cluster, whose executors share no disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    root = root or getattr(scratch, "local", None)
    if not root:
        root = scratch.local = tempfile.mkdtemp(prefix="lakevec-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    path = f"{root.rstrip('/')}/lakevec-{name}-{uuid.uuid4().hex}"
    _made.paths.append(path)
    return path


def made() -> int:
    """How many scratch tables of this thread there are."""
    return len(_made.paths)


def clean(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Remove this thread's scratch tables but for the ``since`` oldest and the ``keep`` newest; say how many there were.

    For when all results that read them are written: results are lazy, so nothing removes them earlier.
    """
    paths, hadoop = _made.paths[since : made() - keep], spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        p = hadoop.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _made.paths.remove(path)
    return len(paths)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared scratch table and read it back, which cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_within(df: DataFrame, by: list[str], key: list[str], out: str, n_rows: int) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each value of ``by``, whatever the size of the groups.

    Every group is dealt over hash buckets of ``key``; rows are numbered inside a bucket and moved up by the sizes of
    the buckets before it. No task sees more than one bucket of a group at once, so that a group holding most rows
    does no harm. ``by`` must be free of nulls; null keys are hashed like any value; rows equal in ``key`` get
    different numbers in any order.
    """
    buckets = max(16, -(-n_rows // ROWS_PER_BUCKET))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*key, F.lit("number")), F.lit(buckets)))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    offsets = offsets.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*key)
    numbered = dealt.withColumn("_rank", F.row_number().over(inside))
    return (
        numbered.join(offsets, [*by, "_bucket"])
        .withColumn(out, (F.col("_offset") + F.col("_rank") - 1).cast("long"))
        .drop("_bucket", "_rank", "_offset")
    )


def squeezed(text: Column) -> Column:
    """Null as empty; every run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")
