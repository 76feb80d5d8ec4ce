"""The reports. Each takes the tables and a date window (both ends included)
and returns a lazy DataFrame.

Lines with a null in the reporting dimension are left out of that report. Sort
keys always end in the group key, so top-n results are the same on every run.
Bad arguments raise ValueError before any job starts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.dates import as_date, bucket_date, in_window, previous_window
from shelfline.functions.money import (
    cost_sum, dollars, line_revenue, mean_unit_margin, percent, ratio, revenue_sum, rounded, units_sum,
)
from shelfline.functions.text import is_product_code
from shelfline.operators.baskets import top_pairs
from shelfline.sources.tables import Tables

SALES_DIMENSIONS = ("category", "region", "channel", "store_id")
FORECAST_DIMENSIONS = ("category", "store_id", "product_id", "region", "overall")
_PRODUCT = ["product_id", "product_name", "category"]


def _check_dimension(dimension: str, allowed: tuple[str, ...]) -> None:
    if dimension not in allowed:
        raise ValueError(f"unknown dimension {dimension!r}, use one of {allowed}")


def _check_count(n: int) -> None:
    if n < 1:
        raise ValueError("the number of rows asked for must be positive")


def _sales(tables: Tables, start: str | date, end: str | date,
           category: str | None = None) -> DataFrame:
    lines = in_window(tables.transactions, start, end)
    return lines.where(F.col("category") == category) if category else lines


def describe_data(tables: Tables) -> DataFrame:
    """One row: the time window covered, the distinct channels, categories and
    regions in order, and the number of lines and of products."""
    cells = (
        tables.transactions
        .groupBy("channel", "category", "region", "product_id")
        .agg(F.count(F.lit(1)).alias("lines"),
             F.min("sale_date").alias("first"), F.max("sale_date").alias("last"))
    )
    products = cells.where(F.col("product_id").isNotNull()).select("product_id").distinct()

    def listed(column: str):
        return F.array_sort(F.collect_set(column)).alias(
            {"channel": "channels", "category": "categories", "region": "regions"}[column])

    return cells.agg(
        F.date_format(F.min("first"), "yyyy-MM-dd").alias("window_start"),
        F.date_format(F.max("last"), "yyyy-MM-dd").alias("window_end"),
        listed("channel"), listed("category"), listed("region"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_transactions"),
    ).withColumn("total_products",
                 products.agg(F.count(F.lit(1)).alias("n")).scalar())


def describe_stores(tables: Tables) -> DataFrame:
    return tables.stores.select(
        "store_id", "store_name", "city", "state", "region", "store_type")


def rescued_transactions(raw_pos: DataFrame) -> DataFrame:
    """Ids of register rows whose identifier was no product code; a missing
    identifier counts as none."""
    return (
        raw_pos.where(~is_product_code(F.col("upc_or_name")))
        .select("transaction_id").distinct()
    )


def kpi_summary(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """One row of totals; all zero for a window without sales.

    Rescued revenue comes from lines whose register entry had to be resolved;
    the register side is not limited to the window.
    """
    lines = _sales(tables, start, end)
    # The ids are made distinct first, so that a much-copied register row is one
    # row in the join, and each line is read once, with its mark.
    marked = rescued_transactions(tables.raw_pos).withColumn("is_rescued", F.lit(True))
    rescued = F.sum(F.when(F.col("is_rescued"), line_revenue()))
    row = lines.join(marked, "transaction_id", "left").agg(
        revenue_sum().alias("revenue"), units_sum().alias("units"),
        F.countDistinct("order_id").alias("orders"),
        F.coalesce(rescued, F.lit(0)).alias("rescued"))
    return row.select(
        dollars(F.col("revenue")).alias("total_revenue"),
        F.col("units").alias("total_units_sold"),
        F.coalesce(rounded(ratio(dollars(F.col("revenue")), F.col("orders")), 2), F.lit(0.0))
        .alias("average_order_value"),
        dollars(F.col("rescued")).alias("ai_rescued_revenue"),
        F.coalesce(percent(F.col("rescued"), F.col("revenue"), 2), F.lit(0.0))
        .alias("ai_rescued_revenue_pct"),
    )


def sales_over_time(tables: Tables, start: str | date, end: str | date,
                    granularity: str = "week", dimension: str = "category") -> DataFrame:
    """Revenue by time bucket and dimension; buckets without sales are absent,
    and the first week may begin before `start`."""
    _check_dimension(dimension, SALES_DIMENSIONS)
    day = bucket_date(F.col("sale_date"), granularity)
    return (
        _sales(tables, start, end).where(F.col(dimension).isNotNull())
        .groupBy(day.alias("bucket"), dimension)
        .agg(dollars(revenue_sum()).alias("revenue"))
        .withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))
        .orderBy("bucket", dimension)
    )


def sales_by_dimension(tables: Tables, start: str | date, end: str | date,
                       dimension: str = "region") -> DataFrame:
    _check_dimension(dimension, SALES_DIMENSIONS)
    return (
        _sales(tables, start, end).where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(dollars(revenue_sum()).alias("revenue"),
             units_sum().alias("units_sold"),
             F.countDistinct("order_id").alias("orders"))
        .orderBy(F.desc("revenue"), dimension)
    )


def top_products(tables: Tables, start: str | date, end: str | date, n: int = 10,
                 category: str | None = None, with_growth: bool = False) -> DataFrame:
    """The n products with most revenue. `with_growth` adds the revenue of the
    equally long window before and the change in percent, null if there was no
    revenue then."""
    _check_count(n)
    if not with_growth:
        return (
            _sales(tables, start, end, category)
            .groupBy(*_PRODUCT)
            .agg(dollars(revenue_sum()).alias("revenue"), units_sum().alias("units_sold"))
            .orderBy(F.desc("revenue"), "product_id", "product_name")
            .limit(n)
        )
    # Both windows, which adjoin, in one scan and one aggregation.
    current = F.col("sale_date") >= F.lit(as_date(start))
    cells = (
        _sales(tables, previous_window(start, end)[0], end, category)
        .groupBy(*_PRODUCT)
        .agg(F.count_if(current).alias("lines"),
             F.coalesce(F.sum(F.when(current, line_revenue())), F.lit(0)).alias("cents"),
             F.coalesce(F.sum(F.when(current, F.col("quantity").cast("bigint"))), F.lit(0))
             .alias("units_sold"),
             F.coalesce(F.sum(F.when(~current, line_revenue())), F.lit(0)).alias("prior_cents"))
    )
    # A product may have had another name before.
    prior = cells.groupBy("product_id").agg(dollars(F.sum("prior_cents")).alias("prior"))
    best = (
        cells.where(F.col("lines") > 0)
        .select(*_PRODUCT, dollars(F.col("cents")).alias("revenue"), "units_sold")
        .orderBy(F.desc("revenue"), "product_id", "product_name")
        .limit(n)
    )
    before = F.coalesce("prior", F.lit(0.0))
    return (
        best.join(prior, "product_id", "left")
        .select(*_PRODUCT, "revenue", "units_sold", before.alias("prior_revenue"),
                percent(F.col("revenue") - before, before, 1).alias("growth_pct"))
        .orderBy(F.desc("revenue"), "product_id", "product_name")
    )


def forecast_vs_actual(tables: Tables, start: str | date, end: str | date,
                       dimension: str = "category") -> DataFrame:
    """Forecast and actual revenue and units side by side.

    A forecast week counts in full if its Monday lies in the window, so at the
    edges forecast and actual cover slightly different days. No forecast in the
    window means no rows. Forecasts of unknown products or stores are part of
    "overall" but of no category or region.
    """
    _check_dimension(dimension, FORECAST_DIMENSIONS)
    planned = in_window(tables.forecasts, start, end, "week_start")
    lines = _sales(tables, start, end)
    plan_cents = F.coalesce(
        F.sum(F.rint(F.col("forecasted_revenue").cast("double") * 100).cast("bigint")), F.lit(0))
    plan_sums = [plan_cents.alias("plan_cents"),
                 F.coalesce(F.sum(F.col("forecasted_units").cast("bigint")), F.lit(0))
                 .alias("plan_units")]
    sale_sums = [revenue_sum().alias("sale_cents"), units_sum().alias("sale_units")]
    nothing = F.lit(0).cast("bigint")
    delta = percent(F.col("sale_cents") - F.col("plan_cents"), F.col("plan_cents"), 1)
    figures = [
        dollars(F.col("plan_cents")).alias("forecasted_revenue"),
        F.col("plan_units").alias("forecasted_units"),
        dollars(F.col("sale_cents")).alias("actual_revenue"),
        F.col("sale_units").alias("actual_units"),
        delta.alias("revenue_delta_pct"),
    ]

    if dimension == "overall":
        plan = planned.agg(*plan_sums, F.count(F.lit(1)).alias("weeks")).select(
            "*", nothing.alias("sale_cents"), nothing.alias("sale_units"))
        sale = lines.agg(*sale_sums).select(
            nothing.alias("plan_cents"), nothing.alias("plan_units"), nothing.alias("weeks"), "*")
        both = plan.unionByName(sale).agg(*[
            F.sum(c).alias(c)
            for c in ("plan_cents", "plan_units", "weeks", "sale_cents", "sale_units")])
        return both.where(F.col("weeks") > 0).select(*figures)

    if dimension in ("category", "region"):
        # Summed per key first, so the join sees one row per product or store.
        key, owner = (("product_id", tables.products) if dimension == "category"
                      else ("store_id", tables.stores))
        per_key = planned.groupBy(key).agg(*plan_sums)
        plan = (
            per_key.join(owner.select(key, dimension), key)
            .where(F.col(dimension).isNotNull())
            .groupBy(dimension)
            .agg(F.sum("plan_cents").alias("plan_cents"), F.sum("plan_units").alias("plan_units"))
        )
    else:
        plan = planned.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(*plan_sums)
    sale = lines.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(*sale_sums)
    sums = ["plan_cents", "plan_units", "sale_cents", "sale_units"]
    return (
        plan.join(sale, dimension, "full_outer")
        .where(planned.select(F.lit(1)).limit(1).exists())
        .fillna(0, subset=sums)
        .select(dimension, *figures)
        .orderBy(F.desc("forecasted_revenue"), dimension)
    )


def product_pairs(tables: Tables, start: str | date, end: str | date,
                  top_n: int = 20) -> DataFrame:
    """Names of the product pairs most often found in one order; a product
    missing from the catalog shows its id."""
    _check_count(top_n)
    pairs = top_pairs(_sales(tables, start, end), "order_id", "product_id", top_n)
    names = tables.products
    name_a = names.select(F.col("product_id").alias("a"), F.col("product_name").alias("name_a"))
    name_b = names.select(F.col("product_id").alias("b"), F.col("product_name").alias("name_b"))
    return (
        pairs.join(name_a, "a", "left").join(name_b, "b", "left")
        .orderBy(F.desc("orders"), "first_order", "a", "b")
        .select(F.coalesce("name_a", "a").alias("product_a"),
                F.coalesce("name_b", "b").alias("product_b"),
                F.col("orders").alias("co_occurrences"))
    )


def category_mix_by_channel(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Each category's revenue and its share of the channel's revenue."""
    by_category = (
        _sales(tables, start, end)
        .where(F.col("channel").isNotNull() & F.col("category").isNotNull())
        .groupBy("channel", "category").agg(revenue_sum().alias("cents"))
    )
    whole = F.sum("cents").over(Window.partitionBy("channel"))
    return (
        by_category.select(
            "channel", "category", dollars(F.col("cents")).alias("revenue"),
            percent(F.col("cents"), whole, 1).alias("share_pct"))
        .orderBy("channel", "category")
    )


def revenue_vs_cost(tables: Tables, start: str | date, end: str | date,
                    granularity: str = "week") -> DataFrame:
    """Retail revenue, wholesale cost and gross margin by time bucket."""
    day = bucket_date(F.col("sale_date"), granularity)
    sums = _sales(tables, start, end).groupBy(day.alias("bucket")).agg(
        revenue_sum().alias("revenue"), cost_sum().alias("cost"))
    margin = F.col("revenue") - F.col("cost")
    return sums.select(
        F.date_format("bucket", "yyyy-MM-dd").alias("bucket"),
        dollars(F.col("revenue")).alias("revenue"),
        dollars(F.col("cost")).alias("wholesale_cost"),
        dollars(margin).alias("gross_margin"),
        percent(margin, F.col("revenue"), 1).alias("gross_margin_pct"),
    ).orderBy("bucket")


def product_margins(tables: Tables, start: str | date, end: str | date, n: int = 20,
                    category: str | None = None) -> DataFrame:
    """The n products with the highest margin per unit, a plain mean over their
    sale lines."""
    _check_count(n)
    sums = _sales(tables, start, end, category).groupBy(*_PRODUCT).agg(
        mean_unit_margin().alias("margin_per_unit"), units_sum().alias("units_sold"),
        revenue_sum().alias("revenue"), cost_sum().alias("cost"))
    margin = F.col("revenue") - F.col("cost")
    return sums.select(
        *_PRODUCT, "margin_per_unit", "units_sold",
        dollars(F.col("revenue")).alias("revenue"),
        dollars(margin).alias("total_margin"),
        percent(margin, F.col("revenue"), 1).alias("margin_pct"),
    ).orderBy(F.desc("margin_per_unit"), "product_id", "product_name").limit(n)


def category_breakdown(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Revenue, cost, units, products and margin of each category."""
    sums = (
        _sales(tables, start, end).where(F.col("category").isNotNull())
        .groupBy("category").agg(
            revenue_sum().alias("revenue"), cost_sum().alias("cost"),
            units_sum().alias("units_sold"),
            F.countDistinct("product_id").alias("product_count"))
    )
    margin = F.col("revenue") - F.col("cost")
    return sums.select(
        "category",
        dollars(F.col("revenue")).alias("revenue"),
        dollars(F.col("cost")).alias("wholesale_cost"),
        "units_sold", "product_count",
        dollars(margin).alias("total_margin"),
        percent(margin, F.col("revenue"), 1).alias("margin_pct"),
    ).orderBy(F.desc("revenue"), "category")


def daily_sales_velocity(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Units and revenue of every day of the window, zero on days without
    sales; no rows if `end` is before `start`."""
    first, last = as_date(start), as_date(end)
    days = tables.transactions.sparkSession.range(max((last - first).days + 1, 0)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("sale_date"))
    sold = _sales(tables, start, end).groupBy("sale_date").agg(
        units_sum().alias("units_sold"), dollars(revenue_sum()).alias("revenue"))
    return (
        days.join(sold, "sale_date", "left")
        .fillna(0, subset=["units_sold", "revenue"])
        .orderBy("sale_date")
        .withColumn("sale_date", F.date_format("sale_date", "yyyy-MM-dd"))
    )


def product_scatter(tables: Tables, start: str | date, end: str | date) -> DataFrame:
    """Units, mean margin per unit and revenue of every product sold."""
    return (
        _sales(tables, start, end).groupBy(*_PRODUCT)
        .agg(units_sum().alias("units_sold"), mean_unit_margin().alias("margin_per_unit"),
             dollars(revenue_sum()).alias("revenue"))
        .orderBy(F.desc("revenue"), "product_id", "product_name")
    )


# Name -> report, for callers that pick a report by name.
REPORTS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        describe_data, describe_stores, kpi_summary, sales_over_time, sales_by_dimension,
        top_products, forecast_vs_actual, product_pairs, category_mix_by_channel,
        revenue_vs_cost, product_margins, category_breakdown, daily_sales_velocity,
        product_scatter,
    )
}


def report(name: str, tables: Tables, **arguments) -> DataFrame:
    """The report of that name, also under its name with "get_" in front."""
    found = REPORTS.get(name.removeprefix("get_"))
    if found is None:
        raise ValueError(f"unknown report {name!r}, use one of {sorted(REPORTS)}")
    return found(tables, **arguments)
