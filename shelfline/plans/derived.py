"""Reports computed from other reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.dates import as_date
from shelfline.functions.quantiles import exact_medians
from shelfline.plans import reports
from shelfline.sources.tables import Tables


def product_quadrants(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Products split at the medians of units sold and margin per unit; a value
    on the median counts as high."""
    products = reports.product_scatter(tables, start, end)
    medians = exact_medians(products, ["units_sold", "margin_per_unit"])
    many = F.col("units_sold") >= F.col("median_units")
    rich = F.col("margin_per_unit") >= F.col("median_margin")
    return (
        products.withColumn("medians", medians)
        .withColumn("median_units", F.col("medians.units_sold"))
        .withColumn("median_margin", F.col("medians.margin_per_unit"))
        .drop("medians")
        .withColumn("quadrant",
                    F.when(many & rich, F.lit("Stars"))
                    .when(rich, F.lit("Niche gems"))
                    .when(many, F.lit("Workhorses"))
                    .otherwise(F.lit("Cut candidates")))
    )


def category_top_margin(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Categories with the revenue of all of them, and a flag on the one with
    the highest margin; of equals, the one with more revenue."""
    categories = reports.category_breakdown(tables, start, end)
    total = categories.agg(F.sum(F.col("revenue").cast("decimal(38,2)")).cast("double")).scalar()
    best = (
        categories.orderBy(F.desc_nulls_last("margin_pct"), F.desc("revenue"), "category")
        .limit(1).select("category").scalar()
    )
    return categories.select(
        "category", "revenue", "margin_pct", total.alias("total_revenue"),
        (F.col("category") == best).alias("is_top_margin"))


def category_mix_pivot(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """One row per category with its share in each channel, zero if absent."""
    mix = reports.category_mix_by_channel(tables, start, end)
    return (
        mix.groupBy("category").pivot("channel", ["pos", "ecommerce"])
        .agg(F.first("share_pct"))
        .fillna(0.0, subset=["pos", "ecommerce"])
        .orderBy("category")
    )


def ranked_top_products(tables: Tables, start: str | date, end: str | date,
                        n: int = 10, category: str | None = None) -> DataFrame:
    """The top n products with their place, 1 being the best."""
    top = reports.top_products(tables, start, end, n, category, with_growth=True)
    # A window over n rows only.
    place = F.row_number().over(
        Window.orderBy(F.desc("revenue"), "product_id", "product_name"))
    return top.select(place.alias("rank"), "*").orderBy("rank")


def direction(change: Column) -> Column:
    """Sign class of a change; no change and no value count as up."""
    return F.when(F.coalesce(change, F.lit(0.0)) >= 0, F.lit("up")).otherwise(F.lit("down"))


def delta_direction(tables: Tables, start: str | date, end: str | date,
                    dimension: str = "category") -> DataFrame:
    """Forecast deltas with their direction."""
    frame = reports.forecast_vs_actual(tables, start, end, dimension)
    keys = [] if dimension == "overall" else [dimension]
    return frame.select(*keys, "revenue_delta_pct",
                        direction(F.col("revenue_delta_pct")).alias("direction"))


def regions_by_revenue(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    return reports.sales_by_dimension(tables, start, end, "region") \
        .orderBy(F.desc("revenue"), "region")


def products_by_margin(tables: Tables, start: str | date, end: str | date,
                       n: int = 20) -> DataFrame:
    return reports.product_margins(tables, start, end, n) \
        .orderBy(F.desc("margin_per_unit"), "product_id", "product_name")


def search_names(products: DataFrame, text: str) -> DataFrame:
    """Products whose name contains `text` in any case, with the place of the
    first match counted from 0; blank text finds nothing."""
    needle = text.lower() if text.strip() else None
    name = F.lower("product_name")
    return (
        products.where(F.coalesce(name.contains(F.lit(needle)), F.lit(False)))
        .withColumn("match_offset", F.instr(name, F.lit(needle)) - 1)
    )


def product_search(tables: Tables, start: str | date, end: str | date, text: str,
                   n: int = 50) -> DataFrame:
    """Search among the n products with most revenue in the window."""
    return search_names(reports.top_products(tables, start, end, n), text)


def sales_calendar(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Calendar layout of the daily units: one row per day with its week row
    (weeks begin on Sunday, 0 being the week of `start`), its weekday column and
    an intensity from 1 to 5, equal steps up to the best day."""
    days = reports.daily_sales_velocity(tables, start, end)
    day = F.to_date("sale_date")
    first = F.lit(as_date(start))
    first_sunday = F.date_sub(first, F.dayofweek(first) - 1)
    best = days.agg(F.max("units_sold")).scalar()
    step = F.ceil(F.coalesce(F.try_divide(F.col("units_sold") * F.lit(5), best), F.lit(0)))
    return days.select(
        "sale_date", "units_sold", "revenue",
        F.floor(F.datediff(day, first_sunday) / 7).cast("int").alias("week_row"),
        (F.dayofweek(day) - 1).alias("weekday"),
        F.greatest(step, F.lit(1)).cast("int").alias("level"),
    )
