"""Staging tables: the raw feeds as they came, plus when and where from. Lines
that cannot be used are staged too, with the reason."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.sources.raw import LINE, REASON, accepted, flatten_customer

# Spark's record ids number the rows of a task in so many low bits.
ROW_BITS = 33


def stamped(raw: DataFrame, loaded_at: datetime | None) -> DataFrame:
    """Add the load time and put it in front of the order, so that an earlier
    load comes before a later one whatever the files are called."""
    return (
        raw.withColumn("ingested_at", F.lit(loaded_at or datetime.now(timezone.utc)))
        .withColumn("ingest_order", F.struct(
            F.col("ingested_at").alias("loaded"), F.col("ingest_order.*")))
    )


def stage_pos(raw_pos: DataFrame, path: str, mode: str = "append",
              loaded_at: datetime | None = None) -> None:
    stamped(raw_pos, loaded_at).write.mode(mode).parquet(path)


def stage_orders(raw_orders: DataFrame, path: str, mode: str = "append",
                 loaded_at: datetime | None = None) -> None:
    stamped(flatten_customer(raw_orders), loaded_at).write.mode(mode).parquet(path)


def usable(staged: DataFrame) -> DataFrame:
    """Without what was rejected, if it is a table of a checked feed."""
    return accepted(staged) if REASON in staged.columns else staged


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a staged feed that could not be used."""
    return spark.read.parquet(path).where(F.col(REASON).isNotNull()).select(
        "ingested_at", "ingest_order", REASON, LINE)


def numbered(staged: DataFrame) -> DataFrame:
    """`ingest_order` as one number: the place of a row among all that were
    staged. Blocks of the files are ranked by load, file and offset, which reads
    three narrow columns; the row's place in its block is added."""
    block = ["loaded", "file", "block"]
    # A row for each block of a file: what Spark's own file listing holds.
    ranks = staged.select("ingest_order.loaded", "ingest_order.file", "ingest_order.block") \
        .distinct().select(F.struct(*block).alias("at"), (
            F.row_number().over(Window.orderBy(*block)) - 1).alias("rank"))
    at = F.struct(*[F.col(f"ingest_order.{c}").alias(c) for c in block])
    place = F.shiftleft(F.col("rank").cast("bigint"), ROW_BITS).bitwiseOR(
        F.col("ingest_order.row").bitwiseAND((1 << ROW_BITS) - 1))
    return (
        staged.withColumn("at", at).join(ranks, "at")
        .withColumn("ingest_order", place).select(*staged.columns)
    )


def read_staged(spark: SparkSession, path: str,
                loaded_at: datetime | None = None) -> DataFrame:
    """The usable rows of a staging table, or of one load of it, numbered."""
    staged = usable(spark.read.parquet(path))
    if loaded_at is not None:
        staged = staged.where(F.col("ingested_at") == F.lit(loaded_at))
    return numbered(staged)
