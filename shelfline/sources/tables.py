"""Reading and writing the reference tables and the clean table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.sources import staging


@dataclass(frozen=True)
class Tables:
    """What the reports read. All members are lazy DataFrames."""

    transactions: DataFrame
    products: DataFrame
    stores: DataFrame
    forecasts: DataFrame
    raw_pos: DataFrame


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A whole Parquet table; nothing is paged or cut off."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """The clean table under the declared types, with `sale_month` on top so
    that date windows can skip directories."""
    return typed_transactions(spark.read.parquet(path))


def typed_transactions(stored: DataFrame) -> DataFrame:
    """Stored lines under the declared types."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name)
             for f in schemas.TRANSACTIONS if f.name in stored.columns]
    if "sale_month" in stored.columns:
        typed.append(F.col("sale_month").cast("date").alias("sale_month"))
    return stored.select(*typed)


def read_tables(spark: SparkSession, root: str) -> Tables:
    return Tables(
        transactions=read_transactions(spark, f"{root}/transactions"),
        products=read_table(spark, f"{root}/products", schemas.PRODUCTS),
        stores=read_table(spark, f"{root}/stores", schemas.STORES),
        forecasts=read_table(spark, f"{root}/forecasts"),
        raw_pos=staging.usable(read_table(spark, f"{root}/raw_pos")),
    )


def typed_lines(lines: DataFrame, *extra) -> DataFrame:
    """The columns of the clean table under their declared types, and the month
    that it is laid out by."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name)
             for f in schemas.TRANSACTIONS if f.name != "inserted_at"]
    return lines.select(*typed, *extra, F.trunc("sale_date", "month").alias("sale_month"))


def _stamped(lines: DataFrame, loaded_at: datetime, *extra: str) -> DataFrame:
    return typed_lines(lines, *extra, F.lit(loaded_at).alias("inserted_at"))


def _write(rows: DataFrame, path: str, mode: str, *partitions: str) -> None:
    """Write by month. The rebalance hint lets Spark merge small partitions and
    split one that holds much of the data over several tasks."""
    (
        rows.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, "sale_date", "category", "store_id")
        .write.mode(mode).option("partitionOverwriteMode", "static")
        .partitionBy(*partitions).parquet(path)
    )


def write_transactions(clean: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write the clean table and return the number of rows written.

    "overwrite" rebuilds the table, so a rerun leaves one copy; "append" adds a
    further load.
    """
    spark = clean.sparkSession
    loaded_at = datetime.now(timezone.utc)
    _write(_stamped(clean, loaded_at), path, mode, "sale_month")
    # Counted in the written files: counters kept by tasks would count a lost
    # and repeated task twice.
    written = spark.read.parquet(path).where(F.col("inserted_at") == F.lit(loaded_at))
    return written.count()


def write_lines(lines: DataFrame, path: str) -> None:
    """Write classified sale lines by outcome and month, replacing the last run."""
    rows = _stamped(lines, datetime.now(timezone.utc), "outcome", "copies", "routed")
    _write(rows, path, "overwrite", "outcome", "sale_month")


def freshness(transactions: DataFrame) -> DataFrame:
    """When the clean table was last loaded."""
    return transactions.agg(F.max("inserted_at").alias("last_loaded"))
