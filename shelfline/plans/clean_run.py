"""From the raw feeds to the clean table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import cleaning, enrich, resolver
from shelfline.session import configure
from shelfline.sources import line_store, raw, staging
from shelfline.sources.tables import (
    read_table,
    read_transactions,
    typed_lines,
    typed_transactions,
    write_lines,
)

LOADED = "loaded"
UNKNOWN_PRODUCT = "unknown_product"
BAD_TIME = "bad_time"

# Where a run leaves its tables below its root directory.
POS_STAGE, ORDER_STAGE = "raw_pos", "raw_orders"
UNMATCHED, RESOLUTION, ALIASES = "unmatched", "resolution", "product_alias"
SALE_LINES, FRESH_LINES = "sale_lines", "fresh_lines"


def unmatched(raw_pos: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct identifiers of both feeds that are no catalog id. Read from the
    feeds directly: copies do not matter for a set of strings."""
    seen = raw_pos.select(F.col("upc_or_name").alias("product_identifier")).unionByName(
        orders.select(F.explode("items.sku").alias("product_identifier")))
    return cleaning.unmatched_identifiers(seen, products)


def resolve(raw_pos: DataFrame, orders: DataFrame, products: DataFrame,
            aliases: DataFrame | None = None,
            scorer: resolver.Scorer | None = None) -> DataFrame:
    """Resolution of every identifier of the feeds that is no catalog id."""
    return resolver.resolve_products(
        unmatched(raw_pos, orders, products), products, aliases, scorer)


def classified_lines(raw_pos: DataFrame, orders: DataFrame, products: DataFrame,
                     resolution: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """Every line once, with its catalog columns, the number of `copies` it
    stands for, whether it was `routed` to the fulfillment center, and its
    `outcome`: loaded, or why not."""
    lines = cleaning.distinct_lines(raw_pos, orders, on_error)
    return with_outcome(lines, enrich.product_lookup(products, resolution))


def with_outcome(lines: DataFrame, lookup: DataFrame) -> DataFrame:
    """Parsed lines with their catalog columns, store, `routed` and `outcome`."""
    marked = cleaning.route_missing_stores(
        lines.withColumn("routed", cleaning.store_is_missing()))
    known = enrich.join_products(marked, lookup, "left")
    return known.withColumn(
        "outcome",
        F.when(F.col("product_id").isNull(), F.lit(UNKNOWN_PRODUCT))
        .when(F.col("sale_timestamp").isNull(), F.lit(BAD_TIME))
        .otherwise(F.lit(LOADED)))


def finished_lines(lines: DataFrame, stores: DataFrame) -> DataFrame:
    return enrich.price_columns(enrich.join_stores(lines, stores))


def build_transactions(raw_pos: DataFrame, orders: DataFrame, products: DataFrame,
                       stores: DataFrame, aliases: DataFrame | None = None,
                       scorer: resolver.Scorer | None = None,
                       on_error: str = "quarantine") -> DataFrame:
    """The clean table as one lazy plan over the staged feeds."""
    resolution = resolve(raw_pos, orders, products, aliases, scorer)
    lines = classified_lines(raw_pos, orders, products, resolution, on_error)
    good = lines.where(F.col("product_id").isNotNull() & F.col("sale_timestamp").isNotNull())
    return finished_lines(good, stores).select(*schemas.TRANSACTION_COLUMNS)


def _line_counters() -> dict[str, Column]:
    """Counters of classified lines. Each line knows how many copies it stands
    for, so one pass over a few columns counts what came in and what went out."""
    def lines_with(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome)

    def copies_in(channel: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("channel") == channel, F.col("copies"))), F.lit(0))

    return {
        "raw_pos_rows": copies_in("pos"),
        "exploded_lines": copies_in("ecommerce"),
        "lines_after_dedup": F.count(F.lit(1)),
        "duplicates_removed": F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)),
        "routed_to_fulfillment": F.count_if("routed"),
        "unknown_rows_dropped": lines_with(UNKNOWN_PRODUCT),
        "bad_time_rows_dropped": lines_with(BAD_TIME),
        "final_rows": lines_with(LOADED),
    }


def _identifier_counters(resolution: DataFrame) -> DataFrame:
    return resolution.agg(
        F.count(F.lit(1)).alias("unmatched_identifiers"),
        F.count_if(F.col("product_id") != resolver.UNKNOWN).alias("resolutions_made"))


def _order_counters(orders: DataFrame) -> DataFrame:
    # An order in several documents is one order.
    first = F.col("first_item") == 0 if "first_item" in orders.columns else F.lit(True)
    return orders.agg(F.count_if(first).alias("raw_orders"))


def run_summary(lines: DataFrame, orders: DataFrame,
                resolution: DataFrame | None = None) -> DataFrame:
    """(metric, value): the counters of a run, from its classified lines.

    Without a stored `resolution` the identifiers are counted in the lines, whose
    products were looked up by it: every identifier that is no catalog id is in
    one at least.
    """
    by_order = _long(_order_counters(orders))
    counters = [c.alias(name) for name, c in _line_counters().items()]
    if resolution is not None:
        return _long(lines.agg(*counters)).unionByName(
            _long(_identifier_counters(resolution))).unionByName(by_order)
    # One aggregation by identifier, so that the lines are made once.
    parts = lines.groupBy("product_identifier", "product_id").agg(*counters)
    unmatched_id = F.col("product_identifier").isNotNull() & ~F.col(
        "product_identifier").eqNullSafe(F.col("product_id"))
    whole = parts.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _line_counters()],
        F.count_if(unmatched_id).alias("unmatched_identifiers"),
        F.count_if(unmatched_id & F.col("product_id").isNotNull()).alias("resolutions_made"))
    return _long(whole).unionByName(by_order)


def _long(row: DataFrame) -> DataFrame:
    """A one-row frame of counters as (metric, value)."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value"))
        for c in row.columns])))


def _stage_and_resolve(spark: SparkSession, pos_path: str, orders_path: str, root: str,
                       scorer: resolver.Scorer | None, json_array: bool,
                       mode: str, loaded_at: datetime
                       ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stage the files; the staged rows of both feeds, the catalog, and the
    resolution of the names that are in them."""
    pos_stage, order_stage = f"{root}/{POS_STAGE}", f"{root}/{ORDER_STAGE}"
    staging.stage_pos(raw.check_pos_csv(spark, pos_path), pos_stage, mode, loaded_at)
    staging.stage_orders(
        raw.check_orders_json(spark, orders_path, json_array), order_stage, mode, loaded_at)
    raw_pos = staging.read_staged(spark, pos_stage, loaded_at)
    orders = staging.read_staged(spark, order_stage, loaded_at)
    products = read_table(spark, f"{root}/products", schemas.PRODUCTS)

    # The strings are written before they are resolved: the rules read them
    # several times, the feeds are read for them once.
    unmatched(raw_pos, orders, products) \
        .write.mode("overwrite").parquet(f"{root}/{UNMATCHED}")
    aliases = resolver.load_aliases(spark, f"{root}/{ALIASES}")
    resolver.resolve_products(
        spark.read.parquet(f"{root}/{UNMATCHED}"), products, aliases, scorer,
    ).write.mode("overwrite").parquet(f"{root}/{RESOLUTION}")
    resolution = spark.read.parquet(f"{root}/{RESOLUTION}")
    resolver.save_aliases(resolution, f"{root}/{ALIASES}")
    return raw_pos, orders, products, resolution


def _rejected_counts(spark: SparkSession, root: str, loaded_at: datetime) -> DataFrame:
    """(metric, value): lines of a load's files that could not be used."""
    def count(stage: str, name: str) -> DataFrame:
        rows = staging.read_rejected(spark, f"{root}/{stage}")
        return rows.where(F.col("ingested_at") == F.lit(loaded_at)).agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("metric"), "value")
    return count(POS_STAGE, "pos_lines_rejected").unionByName(
        count(ORDER_STAGE, "orders_rejected"))


def run(spark: SparkSession, pos_path: str, orders_path: str, root: str,
        scorer: resolver.Scorer | None = None, on_error: str = "quarantine",
        json_array: bool = False) -> DataFrame:
    """Stage the files, resolve, write the sale lines, return the counters.

    `root` is shared storage with `products` and `stores`; everything a run
    makes is written there. The lines are written once, by outcome: those that
    were loaded are the clean table, the others stay readable beside it, as do
    lines of the files that are no rows at all (`staging.read_rejected`).

    Every stage ends in a written table, so a lost executor costs at most the
    stage it was in. The lines are counted while they are written; if the number
    is not that of the written table, they are counted there.
    """
    configure(spark)
    loaded_at = datetime.now(timezone.utc)
    raw_pos, orders, products, resolution = _stage_and_resolve(
        spark, pos_path, orders_path, root, scorer, json_array, "overwrite", loaded_at)
    stores = read_table(spark, f"{root}/stores", schemas.STORES)
    lines = classified_lines(raw_pos, orders, products, resolution, on_error)
    counted = Observation("sale lines")
    counters = [c.alias(name) for name, c in _line_counters().items()]
    write_lines(finished_lines(lines, stores).observe(counted, *counters),
                f"{root}/{SALE_LINES}")
    written = spark.read.parquet(f"{root}/{SALE_LINES}")
    values = counted.get
    if values["lines_after_dedup"] == written.count():    # from the files' footers
        by_line = spark.createDataFrame(
            [(k, int(v)) for k, v in values.items()], "metric string, value bigint")
    else:    # a task that was lost and repeated has been observed twice
        by_line = _long(written.agg(*counters))
    return (
        by_line.unionByName(_long(_identifier_counters(resolution)))
        .unionByName(_long(_order_counters(orders)))
        .unionByName(_rejected_counts(spark, root, loaded_at))
    )


# The copies of a line have these in common in the stored table: its store is the
# one it came with, not the one it was routed to.
STORED_KEY = ["transaction_id", "product_identifier", "copy_store"]


def load(spark: SparkSession, pos_path: str, orders_path: str, root: str,
         scorer: resolver.Scorer | None = None, on_error: str = "quarantine",
         json_array: bool = False, everywhere: bool = False) -> DataFrame:
    """Add the files to what earlier loads left below `root` and return the
    counters of this load. Lines that an earlier load has are dropped as copies,
    so loads one after the other end in the table that one `run` over all their
    files gives. See `line_store` for the layout and for `everywhere`.
    """
    configure(spark)
    number, loaded_at = line_store.next_run(spark, root), datetime.now(timezone.utc)
    raw_pos, orders, products, resolution = _stage_and_resolve(
        spark, pos_path, orders_path, root, scorer, json_array, "append", loaded_at)
    stores = read_table(spark, f"{root}/stores", schemas.STORES)
    lines = classified_lines(raw_pos, orders, products, resolution, on_error)
    keyed = finished_lines(lines, stores).withColumn(
        "copy_store", F.when(~F.col("routed"), F.col("store_id")))
    # Written before it is merged: the merge reads it several times.
    fresh_path = f"{root}/{FRESH_LINES}/run={number}"
    typed_lines(keyed, "outcome", "copies", "routed", "product_identifier", "copy_store",
                F.lit(loaded_at).alias("inserted_at"), F.lit(number).alias("first_run")) \
        .write.mode("overwrite").parquet(fresh_path)
    fresh = spark.read.parquet(fresh_path)
    months = line_store.add_lines(fresh, root, number, everywhere, STORED_KEY)
    added = line_store.read_lines(spark, root, number).where(F.col("first_run") == number)
    counters = added.agg(
        F.count(F.lit(1)).alias("lines_added"),
        F.lit(len(months)).alias("months_written"), F.lit(number).alias("run"))
    return run_summary(fresh, orders, resolution).unionByName(_long(counters)).unionByName(
        _rejected_counts(spark, root, loaded_at))


def read_loaded(spark: SparkSession, root: str, run: int | None = None) -> DataFrame:
    """The clean table after a load, the last by default."""
    lines = line_store.read_lines(spark, root, run)
    return typed_transactions(lines.where(F.col("outcome") == LOADED))


def read_run(spark: SparkSession, root: str) -> DataFrame:
    """The clean table of the last run."""
    return read_transactions(spark, f"{root}/{SALE_LINES}/outcome={LOADED}")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the last run that were not loaded, with their outcome."""
    return spark.read.parquet(f"{root}/{SALE_LINES}").where(F.col("outcome") != LOADED)
