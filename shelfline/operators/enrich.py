"""Joining sale lines to the reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.money import to_price
from shelfline.operators.resolver import drop_unknown

_CATALOG = ["product_id", "product_name", "category", "unit_price_cents"]


def product_lookup(products: DataFrame, resolution: DataFrame | None = None) -> DataFrame:
    """Catalog columns by product identifier: every catalog id, plus every
    string the resolver gave a product. One lookup means one join of the lines,
    whichever way an identifier was recognised."""
    catalog = products.select(F.col("product_id").alias("product_identifier"), *_CATALOG)
    if resolution is None:
        return catalog
    resolved = (
        drop_unknown(resolution)
        .select(F.col("identifier").alias("product_identifier"), "product_id")
        .join(products.select(*_CATALOG), "product_id")
    )
    return catalog.unionByName(resolved)


def join_products(lines: DataFrame, lookup: DataFrame, how: str = "inner") -> DataFrame:
    """Add the catalog columns. The inner join drops what no rule recognised;
    `how="left"` keeps it with a null product for the reject report."""
    return lines.join(lookup, "product_identifier", how)


def join_stores(lines: DataFrame, stores: DataFrame) -> DataFrame:
    """Add the region of the store, null for a store that is not listed."""
    return lines.join(stores.select("store_id", "region"), "store_id", "left")


def price_columns(lines: DataFrame) -> DataFrame:
    """Wholesale and charged price in dollars."""
    return lines.withColumns({
        "unit_price": to_price(F.col("unit_price_cents")),
        "sale_price": to_price(F.col("sale_price_cents")),
    })


def enrich(lines: DataFrame, lookup: DataFrame, stores: DataFrame,
           how: str = "inner") -> DataFrame:
    return price_columns(join_stores(join_products(lines, lookup, how), stores))
