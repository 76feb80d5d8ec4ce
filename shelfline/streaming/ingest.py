"""Continuous ingestion of the raw feeds into the clean table.

The same cleaning functions as in the batch run, on file streams. The copy that
arrives first wins; its key is kept for `late_by` after that. The watermark is on
the time of arrival, so no line is late, whatever its sale time is.

Every micro-batch is written under its own number: the deduplicated lines, the
resolution of their names, then every line by its outcome, as in the batch run:
loaded, or why not. A batch that is repeated after a failure replaces what it
wrote before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline import schemas
from shelfline.operators import cleaning, enrich, resolver
from shelfline.plans import clean_run
from shelfline.sources import raw
from shelfline.sources.tables import read_table, typed_lines


def _arrival() -> Column:
    return F.struct(F.col("_metadata.file_modification_time").alias("at"),
                    F.col("_metadata.file_path").alias("file"))


def pos_stream(spark: SparkSession, path: str) -> DataFrame:
    """The usable register rows of the CSV files that turn up in a directory."""
    return cleaning.normalize_pos(raw.accepted(raw.stream_pos_csv(spark, path, _arrival())))


def order_stream(spark: SparkSession, path: str) -> DataFrame:
    """Items of the usable orders in the JSON Lines files that turn up in a directory."""
    orders = raw.accepted(raw.stream_orders_json(spark, path, _arrival()))
    return cleaning.explode_orders(orders.select(
        "order_id", "placed_at", F.col("customer.id").alias("customer_id"),
        "items", "store_id", "ingest_order"))


def reject_stream(spark: SparkSession, pos_path: str, orders_path: str) -> DataFrame:
    """The lines of both feeds that cannot be used: feed, file, reason, line."""
    feeds = (("pos", raw.stream_pos_csv(spark, pos_path, _arrival())),
             ("orders", raw.stream_orders_json(spark, orders_path, _arrival())))
    pos, orders = (raw.rejected(checked).select(
        F.lit(name).alias("feed"), F.col("ingest_order.at").alias("arrived"),
        F.col("ingest_order.file").alias("file"), raw.REASON, raw.LINE) for name, checked in feeds)
    return pos.unionByName(orders)


def distinct_lines(lines: DataFrame, late_by: str = "1 day") -> DataFrame:
    """Parsed lines without copies; lines with an unreadable time stay."""
    timed = cleaning.parse_timestamps(lines).withColumn("arrived", F.current_timestamp())
    return timed.withWatermark("arrived", late_by) \
        .dropDuplicatesWithinWatermark(cleaning.COPY_KEY).drop("arrived")


def _load_batch(root: str, scorer: resolver.Scorer | None):
    aliases_path = f"{root}/product_alias"

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        lines_path = f"{root}/stream_lines/batch={number}"
        batch.drop("ingest_order").write.mode("overwrite").parquet(lines_path)
        lines = spark.read.parquet(lines_path)

        products = read_table(spark, f"{root}/products", schemas.PRODUCTS)
        stores = read_table(spark, f"{root}/stores", schemas.STORES)
        resolution_path = f"{root}/stream_resolution/batch={number}"
        resolver.resolve_products(
            cleaning.unmatched_identifiers(lines, products), products,
            resolver.load_aliases(spark, aliases_path), scorer,
        ).write.mode("overwrite").parquet(resolution_path)
        resolution = spark.read.parquet(resolution_path)
        if scorer is not None:
            # What a user function found out is worth keeping for later batches.
            resolver.save_aliases(resolution, aliases_path)
        known = clean_run.with_outcome(lines, enrich.product_lookup(products, resolution))
        loaded_at = F.current_timestamp().alias("inserted_at")
        (
            typed_lines(clean_run.finished_lines(known, stores), "outcome", "routed", loaded_at)
            .hint("rebalance", "outcome", "sale_month")
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("outcome", "sale_month")
            .parquet(f"{root}/stream_transactions/batch={number}")
        )
    return load


def start(spark: SparkSession, pos_path: str, orders_path: str, root: str,
          late_by: str = "1 day", scorer: resolver.Scorer | None = None,
          **trigger) -> StreamingQuery:
    """Start the ingestion; `trigger` is passed on, e.g. `availableNow=True`.

    `root` is shared storage with `products` and `stores`; progress, state and
    output are kept there, so a restarted query goes on where it stopped.
    """
    lines = cleaning.union_channels(pos_stream(spark, pos_path), order_stream(spark, orders_path))
    writer = (
        distinct_lines(lines, late_by).writeStream
        .option("checkpointLocation", f"{root}/stream_progress")
        .foreachBatch(_load_batch(root, scorer))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_rejects(spark: SparkSession, pos_path: str, orders_path: str, root: str,
                  **trigger) -> StreamingQuery:
    """Keep the lines that `start` leaves out, below `root`/stream_rejects. It
    has its own progress, so either query can be stopped without the other."""
    writer = reject_stream(spark, pos_path, orders_path).writeStream.format("parquet") \
        .option("checkpointLocation", f"{root}/stream_rejects_progress") \
        .option("path", f"{root}/stream_rejects")
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_stream_output(spark: SparkSession, root: str) -> DataFrame:
    """Everything the stream has loaded so far."""
    return spark.read.parquet(f"{root}/stream_transactions").where(
        F.col("outcome") == clean_run.LOADED)


def read_stream_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The lines that the stream could not load, with their outcome."""
    return spark.read.parquet(f"{root}/stream_transactions").where(
        F.col("outcome") != clean_run.LOADED)
