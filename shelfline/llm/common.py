"""Helpers the operators share: session settings, shared storage, checked
broadcasts and connected components."""

from __future__ import annotations

import functools
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import configure

# Rows of one integer key; a table with more is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# Removes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Where stashed tables are.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings: those of the library, and small Arrow batches, so
    that a batch of long texts fits beside others in a worker's memory."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="shelfline-llm-")


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder of spark.checkpoint.dir, which all
    executors share. Only where that is unset, as in tests, it is a local
    one. It goes when the driver ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or _own_folder()
    folder = f"{root.rstrip('/')}/shelfline-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stash(df: DataFrame) -> DataFrame:
    """Write a table to shared storage and read it back: lineage is cut, and
    no lost executor takes any of it along. What was shuffled for it goes when it
    is written; the table itself stays until it is dropped or the driver ends."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(_CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(folder)
    _folders[stored] = folder
    return stored


def drop(*stashed: DataFrame) -> None:
    """Delete stashed tables, and components, all readers of which are written."""
    for df in stashed:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folders.pop(df))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a stored table of narrow rows if it is counted to have at
    most `rows` of them; otherwise Spark joins it by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def bit_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of a graph given as rows (a, b) of longs: rows
    (node, component), component being the smallest node; a node without an
    edge to another is not in the result.

    Alternates the large-star and small-star steps (Kiveris et al. 2014): each
    links the neighbours of a node to the smallest of them, by a minimum that
    is combined before the shuffle and one join, until nothing changes. No
    node's neighbours are gathered in one place; Spark splits hot join keys.
    """
    def signature(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    links = stash(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = signature(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("of"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("of")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "of")
        small = large.join(least, F.col("u") == F.col("of")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("x"),
            "m", "u")
        # A node's own link to the minimum is always among them.
        last, links = links, stash(small.select(
            F.explode(F.array("x", "u")).alias("u"), F.col("m").alias("v")).distinct())
        drop(last)
        after = signature(links)
        if after == before:
            found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = found.select(F.col("component").alias("node"), "component").distinct()
            both = found.union(roots)
            _folders[both] = _folders.pop(links)
            return both
        before = after
