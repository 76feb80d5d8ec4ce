"""Benchmark: seconds per report and per cleaning job, printed as one JSON line.

The sample tables of $BENCH_SF_DIR are first written once as the staged feeds
and the clean table (not timed). Reports then read the clean table, cleaning
jobs read the staged feeds. Each query runs once to warm up and three times
timed, the median counts; cleaning jobs write their whole result to Spark's
"noop" sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle.queries import END, START, WEEK_END, WEEK_START  # noqa: E402
from shelfline.operators import cleaning, resolver  # noqa: E402
from shelfline.plans import adhoc, clean_run, derived, reports  # noqa: E402
from shelfline.session import local_session  # noqa: E402
from shelfline.sources import sample_views as views  # noqa: E402
from shelfline.sources import tables as storage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
W = (START, END)


def stage(spark, root: str):
    """Write the sample tables the way a finished run leaves them."""
    for name in ("products", "stores", "forecasts", "raw_pos", "raw_orders"):
        getattr(views, name)(spark, SF_DIR).write.parquet(f"{root}/{name}")
    storage.write_transactions(views.transactions(spark, SF_DIR), f"{root}/transactions")
    return storage.read_tables(spark, root), spark.read.parquet(f"{root}/raw_orders")


def report_queries(t: storage.Tables) -> dict:
    return {
        "describe_summary": lambda: reports.describe_data(t),
        "kpi_summary": lambda: reports.kpi_summary(t, *W),
        "sales_over_time_day_store": lambda: reports.sales_over_time(t, *W, "day", "store_id"),
        "sales_over_time_week_category": lambda: reports.sales_over_time(t, *W),
        "sales_over_time_month_region": lambda: reports.sales_over_time(t, *W, "month", "region"),
        "sales_by_region": lambda: reports.sales_by_dimension(t, *W, "region"),
        "top_products": lambda: reports.top_products(t, *W),
        "top_products_growth": lambda: reports.top_products(t, *W, with_growth=True),
        "forecast_vs_actual_category": lambda: reports.forecast_vs_actual(t, *W),
        "forecast_vs_actual_product": lambda: reports.forecast_vs_actual(t, *W, "product_id"),
        "forecast_vs_actual_overall": lambda: reports.forecast_vs_actual(t, *W, "overall"),
        "product_pairs": lambda: reports.product_pairs(t, *W),
        "category_mix": lambda: reports.category_mix_by_channel(t, *W),
        "revenue_vs_cost_week": lambda: reports.revenue_vs_cost(t, *W),
        "product_margins": lambda: reports.product_margins(t, *W),
        "category_breakdown": lambda: reports.category_breakdown(t, *W),
        "daily_velocity": lambda: reports.daily_sales_velocity(t, *W),
        "product_scatter": lambda: reports.product_scatter(t, *W),
        "product_quadrants": lambda: derived.product_quadrants(t, *W),
        "raw_after": lambda: adhoc.raw_after(t),
        "week_category_region": lambda: adhoc.week_category_region(t, WEEK_START, WEEK_END),
        # The same over all the years, where the data is larger than the window.
        "all_category_breakdown": lambda: reports.category_breakdown(t, "1995-01-01", "2001-12-31"),
        "all_kpi_summary": lambda: reports.kpi_summary(t, "1995-01-01", "2001-12-31"),
        "all_product_scatter": lambda: reports.product_scatter(t, "1995-01-01", "2001-12-31"),
        "all_product_pairs": lambda: reports.product_pairs(t, "1995-01-01", "2001-12-31"),
    }


def cleaning_queries(t: storage.Tables, orders) -> dict:
    def unmatched():
        return cleaning.unmatched_identifiers(cleaning.normalize_pos(t.raw_pos), t.products)
    def summary():
        resolution = clean_run.resolve(t.raw_pos, orders, t.products)
        lines = clean_run.classified_lines(t.raw_pos, orders, t.products, resolution)
        return clean_run.run_summary(lines, orders)
    return {
        "clean_lines": lambda: cleaning.clean_lines(t.raw_pos, orders),
        "resolve_products": lambda: resolver.resolve_products(unmatched(), t.products),
        "fuzzy_matches": lambda: resolver.fuzzy_matches(unmatched(), t.products),
        "clean_transactions": lambda: clean_run.build_transactions(
            t.raw_pos, orders, t.products, t.stores),
        "run_summary": summary,
    }


def timed(action) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        begin = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = local_session("bench", CPUS, os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    tables, orders = stage(spark, tempfile.mkdtemp(prefix="shelfline-bench-", dir="/tmp"))
    results = {}
    for name, build in report_queries(tables).items():
        results[name] = timed(lambda: build().collect())
    for name, build in cleaning_queries(tables, orders).items():
        results[name] = timed(lambda: build().write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": CPUS, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
