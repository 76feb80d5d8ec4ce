"""Spot checks of the cleaning: raw entries, the same lines cleaned, and one
week by category and region."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import in_window
from shelfline.functions.money import dollars, revenue_sum, units_sum
from shelfline.functions.text import is_product_code
from shelfline.sources.tables import Tables


def _named_entries(raw_pos: DataFrame) -> DataFrame:
    """Register rows with a text in place of a code; missing ones are left out."""
    return raw_pos.where(
        F.col("upc_or_name").isNotNull() & ~is_product_code(F.col("upc_or_name")))


def raw_before(tables: Tables, n: int = 20) -> DataFrame:
    """The first n staged register rows that name a product in words."""
    return (
        _named_entries(tables.raw_pos)
        .select("transaction_id", "upc_or_name", "store_id", "price_charged_cents")
        .orderBy("transaction_id").limit(n)
    )


def raw_after(tables: Tables, n: int = 20, once: bool = False) -> DataFrame:
    """The same rows in the clean table. Staging keeps copies, so a line shows
    as often as it was staged; `once` shows it once."""
    entries = _named_entries(tables.raw_pos).select("transaction_id")
    # Copies are counted before the join, so that one much-copied row is one row.
    counted = entries.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("copies"))
    first = (
        tables.transactions.join(counted, "transaction_id")
        .select("transaction_id", "product_name", "category", "store_id", "region",
                "quantity", F.col("sale_price").cast("double").alias("sale_price"), "copies")
        .orderBy("transaction_id").limit(n)
    )
    if once:
        return first.drop("copies")
    repeats = F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(n).cast("bigint")))
    return (
        first.withColumn("copy", F.explode(repeats)).drop("copies", "copy")
        .orderBy("transaction_id").limit(n)
    )


def week_category_region(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Units and revenue by category and region; lines without a region form a
    group of their own here."""
    return (
        in_window(tables.transactions, start, end)
        .groupBy("category", "region")
        .agg(units_sum().alias("actual_units"),
             dollars(revenue_sum()).alias("actual_revenue"))
        .orderBy(F.desc("actual_revenue"), "category", "region")
    )
