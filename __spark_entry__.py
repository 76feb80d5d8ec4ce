
from __future__ import annotations

import logging
import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle import queries as sql  # noqa: E402
from shelfline import schemas  # noqa: E402
from shelfline.functions.dates import in_window  # noqa: E402
from shelfline.operators import cleaning, enrich, quality, resolver  # noqa: E402
from shelfline.plans import adhoc, clean_run, derived, reports  # noqa: E402
from shelfline.session import configure, size_tables  # noqa: E402
from shelfline.sources import line_store, raw, staging, tables  # noqa: E402
from shelfline.sources import sample_views as views  # noqa: E402
from shelfline.sources.tables import Tables  # noqa: E402

# The operators of the training-data pipeline are optional.
try:
    import corpus_pipeline  # noqa: E402
    from shelfline.llm import queries as llm  # noqa: E402
except ImportError as missing:
    # Also where something they need is not installed: the other queries do without.
    logging.getLogger(__name__).warning("no training-data operators: %s", missing)
    llm = None

Query = Callable[[SparkSession, str], DataFrame]
W = (sql.START, sql.END)


def _prepared(spark: SparkSession, root: str) -> SparkSession:
    return size_tables(configure(spark), views.input_bytes(spark, root))


def _report(report: Callable[..., DataFrame], *args, with_ids: bool = False, **options) -> Query:
    """A report over the sample views. Only reports that look at single lines
    or orders read the view with ids."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        tables = views.SampleTables(_prepared(spark, root), root, with_ids)
        return report(tables, *args, **options)
    return run


def _on_views(build: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        return build(_prepared(spark, root), root)
    return run


def _describe_summary(tables) -> DataFrame:
    lists = ("channels", "categories", "regions")
    return reports.describe_data(tables).withColumns(
        {c: F.array_join(c, ",") for c in lists})


def _feed(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.union_channels(
        cleaning.normalize_pos(views.raw_pos(spark, root)),
        cleaning.explode_orders(views.raw_orders(spark, root)))


def _feeds(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Register rows and orders for queries that read them for the lines, their
    copies and each rule of the resolver: the lines of both are numbered once, and
    the items of an order are gathered once."""
    lines = views.feed_lines(spark, root).persist(StorageLevel.DISK_ONLY)
    orders = views.raw_orders(spark, root, lines).persist(StorageLevel.DISK_ONLY)
    return views.raw_pos(spark, root, lines), orders


def _pos_csv_parsed(spark, root):
    pos = views.raw_pos(spark, root)
    lines = pos.select(F.to_csv(F.struct(*schemas.RAW_POS.names)).alias("line"), "ingest_order")
    return raw.parse_pos_lines(lines, "line", "ingest_order").drop("ingest_order")


def _order_documents(spark, root) -> DataFrame:
    orders = views.raw_orders(spark, root)
    customer = F.struct(F.col("customer_id").alias("id"), "loyalty_tier").alias("customer")
    return orders.select(F.to_json(F.struct(
        "order_id", "placed_at", customer, "items", "fulfillment", "store_id")).alias("document"),
        "ingest_order")


def _orders_json_parsed(spark, root):
    orders = raw.parse_order_documents(_order_documents(spark, root), "document", "ingest_order")
    return orders.select("order_id", "placed_at", F.col("customer.id").alias("customer_id"),
                         "fulfillment", "store_id", F.inline("items")).drop("promo_code")


def _pos_csv_rejects(spark, root):
    checked = raw.check_pos_lines(views.pos_lines(spark, root), "line", "ingest_order")
    return raw.rejected(checked)


def _order_json_rejects(spark, root):
    checked = raw.check_order_documents(
        views.order_documents(spark, root), "document", "ingest_order")
    return raw.rejected(checked).select(
        "ingest_order", "reason", F.length("line").cast("bigint").alias("line_length"))


def _feed_balance(spark, root):
    """Lines that came in, by what became of them."""
    def counted(feed: str, checked: DataFrame) -> DataFrame:
        return checked.groupBy(F.coalesce("reason", F.lit("parsed")).alias("outcome")).agg(
            F.count(F.lit(1)).alias("lines")).withColumn("feed", F.lit(feed))
    return counted("pos", raw.check_pos_lines(
        views.pos_lines(spark, root), "line", "ingest_order")).unionByName(
        counted("orders", raw.check_order_documents(
            views.order_documents(spark, root), "document", "ingest_order")))


def _staged_pos(spark, root):
    """Register rows as they are staged and read back, and the number they get."""
    loaded_at = datetime(2026, 4, 21, tzinfo=timezone.utc)
    staged = staging.numbered(staging.stamped(views.pos_from_files(spark, root), loaded_at))
    return staged.select(*schemas.RAW_POS.names, "ingest_order",
                         F.date_format("ingested_at", "yyyy-MM-dd").alias("ingested_on"))


def _staged_orders(spark, root):
    orders = raw.flatten_customer(raw.parse_order_documents(
        _order_documents(spark, root), "document", "ingest_order"))
    units = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, i: n + i["qty"])
    return orders.groupBy("order_id", "placed_at", "customer_id", "fulfillment", "store_id").agg(
        F.sum(F.size("items")).alias("items"), F.sum(units).alias("units"))


def _clean_table_casts(spark, root):
    stored = tables.typed_lines(views.transactions(spark, root).withColumn(
        "quantity", F.col("quantity").cast("string")))
    return _as_text(stored).withColumn("sale_month", F.date_format("sale_month", "yyyy-MM-dd"))


def _reference_scan(spark, root):
    """A reference table whole, under its declared columns."""
    return tables.read_table(spark, f"{root}/supplier.parquet").select(
        F.col("s_suppkey").cast("bigint").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"))


def _freshness(spark, root):
    """When the clean table was last loaded, lines being loaded a day after they were sold."""
    tx = views.transactions(spark, root).withColumn(
        "inserted_at", F.col("sale_timestamp") + F.expr("interval 1 day"))
    return tables.freshness(tx).select(
        F.date_format("last_loaded", "yyyy-MM-dd HH:mm:ss").alias("last_loaded"))


def _explode_orders(spark, root):
    return cleaning.explode_orders(views.raw_orders(spark, root)).drop("ingest_order")


def _normalized_union(spark, root):
    return _feed(spark, root).drop("ingest_order")


def _as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, prices as double, for comparing engines."""
    shown = {
        "sale_date": F.date_format("sale_date", "yyyy-MM-dd"),
        "sale_timestamp": F.date_format("sale_timestamp", "yyyy-MM-dd HH:mm:ss"),
        "unit_price": F.col("unit_price").cast("double") if "unit_price" in df.columns else None,
        "sale_price": F.col("sale_price").cast("double") if "sale_price" in df.columns else None,
    }
    return df.withColumns({c: e for c, e in shown.items() if c in df.columns})


def _parsed_timestamps(spark, root):
    return _as_text(cleaning.parse_timestamps(_feed(spark, root)).select(
        "transaction_id", "sale_timestamp_raw", "sale_timestamp", "sale_date"))


def _dedup_keep_first(spark, root):
    return cleaning.keep_first_copy(_feed(spark, root)).drop("ingest_order")


def _store_routing(spark, root):
    lines = cleaning.clean_lines(views.raw_pos(spark, root), views.raw_orders(spark, root))
    return lines.groupBy("store_id", "channel").agg(F.count(F.lit(1)).alias("lines"))


def _unmatched(spark, root):
    return clean_run.unmatched(views.raw_pos(spark, root), views.raw_orders(spark, root),
                               views.products(spark, root))


def _resolved_products(spark, root):
    return clean_run.resolve(*_feeds(spark, root), views.products(spark, root))


def _fuzzy_matches(spark, root):
    mistyped = views.mistyped_names(spark, root).select("identifier").distinct()
    return resolver.fuzzy_matches(mistyped, views.products(spark, root))


def _resolver_cascade(spark, root):
    strings, aliases = views.register_strings(spark, root)
    return resolver.resolve_products(strings, views.products(spark, root), aliases)


def _current_aliases(spark, root):
    return resolver.current_aliases(views.alias_history(spark, root))


def _enriched(spark, root):
    pos, orders = _feeds(spark, root)
    lines = cleaning.clean_lines(pos, orders)
    products = views.products(spark, root)
    resolution = clean_run.resolve(pos, orders, products)
    joined = enrich.enrich(
        lines, enrich.product_lookup(products, resolution), views.stores(spark, root))
    return _as_text(joined.select(*schemas.TRANSACTION_COLUMNS))


def _clean_transactions(spark, root):
    return _as_text(clean_run.build_transactions(
        *_feeds(spark, root), views.products(spark, root), views.stores(spark, root)))


def _run_summary(spark, root):
    pos, orders = _feeds(spark, root)
    products = views.products(spark, root)
    resolution = clean_run.resolve(pos, orders, products)
    lines = clean_run.classified_lines(pos, orders, products, resolution)
    return clean_run.run_summary(lines, orders)


def _two_loads(spark, root) -> tuple[DataFrame, DataFrame]:
    """Register lines in two loads: the second begins before the first ends, brings
    again what was sent twice, and has each price a cent higher."""
    lines = cleaning.parse_timestamps(cleaning.normalize_pos(views.raw_pos(spark, root)))
    # The loads and their merge read the feed ten times; it is made once.
    lines = lines.persist(StorageLevel.DISK_ONLY)
    again = F.col("ingest_order") >= 1 << 60
    first = lines.where(~again & (F.col("sale_date") <= F.lit(sql.FIRST_LOAD_END)))
    second = lines.where(F.col("sale_date") >= F.when(again, F.lit(sql.RESENT_START)).otherwise(
        F.lit(sql.SECOND_LOAD_START)).cast("date")).withColumn(
        "sale_price_cents", F.col("sale_price_cents") + 1)
    first, second = (cleaning.keep_first_copy(load).withColumns({
        "sale_month": F.trunc("sale_date", "month"), "first_run": F.lit(n)})
        for n, load in enumerate((first, second), 1))
    return first, second


def _merged_load(spark, root):
    return line_store.merge_lines(*_two_loads(spark, root)).select(
        *cleaning.COPY_KEY, "sale_price_cents", "copies", "first_run")


def _load_months(spark, root):
    """Lines of each month after both loads, and those the second one added."""
    first, second = _two_loads(spark, root)
    touched = second.select("sale_month").distinct().withColumn("written", F.lit(True))
    return line_store.merge_lines(first, second).groupBy("sale_month").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("first_run") == 2).alias("lines_added"),
    ).join(touched, "sale_month", "left").select(
        F.date_format("sale_month", "yyyy-MM-dd").alias("sale_month"), "lines", "lines_added",
        F.coalesce("written", F.lit(False)).alias("written"))


def _faulty_run_summary(spark, root):
    """The counters of a run over feeds with every kind of fault."""
    pos, orders = _feeds(spark, root)
    pos, orders = views.faulty_pos(pos), views.orders_with_empty_ones(orders)
    products = views.products(spark, root)
    resolution = clean_run.resolve(pos, orders, products)
    lines = clean_run.classified_lines(pos, orders, products, resolution)
    return clean_run.run_summary(lines, orders)


def _null_violations(spark, root):
    return quality.null_violations(views.with_null_stores(views.transactions(spark, root)))


def _pk_violations(spark, root):
    return quality.pk_violations(views.with_repeated_rows(views.transactions(spark, root)))


def _domain_violations(spark, root):
    return quality.domain_violations(
        views.with_wrong_channel(views.transactions(spark, root))
    ).select("transaction_id", "channel")


def _fk_violations(spark, root):
    return quality.fk_violations(
        views.with_unlisted_product(views.transactions(spark, root)),
        views.products(spark, root), "product_id").select("product_id", "transaction_id")


def _bad_timestamps(spark, root):
    pos = views.with_unreadable_times(views.raw_pos(spark, root))
    return quality.bad_timestamps(
        cleaning.parse_timestamps(cleaning.normalize_pos(pos))
    ).select("transaction_id", "sale_timestamp_raw")


def _faulty_tables(spark, root) -> dict[str, DataFrame]:
    tx = views.with_unlisted_product(views.with_repeated_rows(views.transactions(spark, root)))
    return {"transactions": tx, "products": views.products(spark, root),
            "stores": views.stores(spark, root), "suppliers": views.suppliers(spark, root),
            "forecasts": views.forecasts(spark, root)}


def _pk_report(spark, root):
    return quality.pk_report(_faulty_tables(spark, root), schemas.PRIMARY_KEYS)


def _fk_report(spark, root):
    return quality.fk_report(_faulty_tables(spark, root))


def _reconciliation(spark, root):
    return quality.reconcile(_run_summary(spark, root))


def _rollup_reconciliation(tables) -> DataFrame:
    lines = in_window(tables.transactions, *W).withColumn("week", F.trunc("sale_date", "week"))
    return quality.reconcile_rollups(lines, ["category", "region", "channel", "week"])


def _faulty_rollup_reconciliation(spark, root):
    tx = views.with_null_regions(views.transactions(spark, root))
    return _rollup_reconciliation(Tables(tx, *[None] * 4))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "describe_summary": _report(_describe_summary),
        "describe_stores": _report(reports.describe_stores),
        "kpi_summary": _report(reports.kpi_summary, *W, with_ids=True),
    }
    for grain in ("day", "week", "month"):
        for dim in reports.SALES_DIMENSIONS:
            found[f"sales_over_time_{grain}_{dim}"] = _report(
                reports.sales_over_time, *W, grain, dim)
        found[f"revenue_vs_cost_{grain}"] = _report(reports.revenue_vs_cost, *W, grain)
    for dim in reports.SALES_DIMENSIONS:
        found[f"sales_by_{dim}"] = _report(
            reports.sales_by_dimension, *W, dim, with_ids=True)
    for dim in reports.FORECAST_DIMENSIONS:
        found[f"forecast_vs_actual_{dim}"] = _report(reports.forecast_vs_actual, *W, dim)
    top = partial(_report, reports.top_products, *W, n=10)
    found.update({
        "regions_by_revenue": _report(derived.regions_by_revenue, *W, with_ids=True),
        "top_products": top(),
        "top_products_category": top(category="PROMO"),
        "top_products_growth": top(with_growth=True),
        "top_products_category_growth": top(category="PROMO", with_growth=True),
        "product_pairs": _report(reports.product_pairs, *W, top_n=20, with_ids=True),
        "category_mix": _report(reports.category_mix_by_channel, *W),
        "category_mix_pivot": _report(derived.category_mix_pivot, *W),
        "product_margins": _report(reports.product_margins, *W),
        "product_margins_category": _report(reports.product_margins, *W, category="PROMO"),
        "products_by_margin": _report(derived.products_by_margin, *W),
        "category_breakdown": _report(reports.category_breakdown, *W),
        "daily_velocity": _report(reports.daily_sales_velocity, *W),
        "product_scatter": _report(reports.product_scatter, *W),
        "product_quadrants": _report(derived.product_quadrants, *W),
        "category_top_margin": _report(derived.category_top_margin, *W),
        "ranked_top_products": _report(derived.ranked_top_products, *W),
        "delta_direction": _report(derived.delta_direction, *W),
        "product_search": _report(lambda t: derived.search_names(t.products, "Ring")),
        "sales_calendar": _report(derived.sales_calendar, *W),
        "raw_before": _report(adhoc.raw_before, with_ids=True),
        "raw_after": _report(adhoc.raw_after, with_ids=True),
        "week_category_region": _report(
            adhoc.week_category_region, sql.WEEK_START, sql.WEEK_END),
        "rollup_reconciliation": _report(_rollup_reconciliation),
    })
    on_views = {
        "pos_csv_parsed": _pos_csv_parsed,
        "orders_json_parsed": _orders_json_parsed,
        "pos_csv_rejects": _pos_csv_rejects,
        "order_json_rejects": _order_json_rejects,
        "feed_balance": _feed_balance,
        "staged_pos": _staged_pos,
        "staged_orders": _staged_orders,
        "clean_table_casts": _clean_table_casts,
        "reference_scan": _reference_scan,
        "freshness": _freshness,
        "explode_orders": _explode_orders,
        "normalized_union": _normalized_union,
        "parsed_timestamps": _parsed_timestamps,
        "dedup_keep_first": _dedup_keep_first,
        "store_routing": _store_routing,
        "unmatched_ids": _unmatched,
        "resolved_products": _resolved_products,
        "fuzzy_matches": _fuzzy_matches,
        "resolver_cascade": _resolver_cascade,
        "current_aliases": _current_aliases,
        "enriched": _enriched,
        "clean_transactions": _clean_transactions,
        "run_summary": _run_summary,
        "faulty_run_summary": _faulty_run_summary,
        "merged_load": _merged_load,
        "load_months": _load_months,
        "null_violations": _null_violations,
        "pk_violations": _pk_violations,
        "domain_violations": _domain_violations,
        "fk_violations": _fk_violations,
        "pk_report": _pk_report,
        "fk_report": _fk_report,
        "bad_timestamps": _bad_timestamps,
        "reconciliation": _reconciliation,
        "rollup_reconciliation_of_loss": _faulty_rollup_reconciliation,
    }
    found.update({name: _on_views(build) for name, build in on_views.items()})
    if llm:
        found.update(llm.QUERIES)
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql() | (llm.ORACLE_SQL if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue, cost and margin by category."""
    return queries()["category_breakdown"](spark, "/root/testdata/sf0.001")
