"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates are UTC dates; naive register times are taken as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Run-time join choice, partition coalescing and splitting of hot keys.
    # The force flag lets a hot join key be split even where that costs one
    # more shuffle further down.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keys of the streaming deduplication are kept on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above; cluster sizing stays with the deployment."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int,
                  partition_bytes: int = 256 << 20) -> SparkSession:
    """Start shuffles of a job over `input_bytes` with partitions of about
    `partition_bytes`; what turns out small is merged again at run time."""
    wanted = -(-input_bytes // partition_bytes)
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                   str(max(wanted, floor)))
    return spark


# Rows of the sample tables are up to this many times their size in Parquet, and the
# stages that sort them hold some 20 times what was shuffled to them.
PARQUET_TO_ROWS = 20
SHUFFLED_BYTES = 16 << 20


def size_tables(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Settings of a job over well compressed tables: what a task holds and what
    is broadcast stay as they are when the tables grow.

    Shuffles start with partitions for 4 MB of the files and are merged up to
    `SHUFFLED_BYTES`. A table is taken for `PARQUET_TO_ROWS` times its files, so
    that none is broadcast whose rows do not fit the broadcast threshold.
    """
    size_shuffles(spark, input_bytes, 4 << 20)
    spark.conf.set("spark.sql.sources.fileCompressionFactor", str(PARQUET_TO_ROWS))
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(merged, f"{min(_bytes(spark, merged), SHUFFLED_BYTES)}b")
    return spark


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(setting))


def local_session(app: str = "shelfline", cores: int | str = "*",
                  driver_memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
