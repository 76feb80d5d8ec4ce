"""Relations between reports that must hold on any data."""

from collections import defaultdict
from datetime import date, timedelta

import pytest

from shelfline.functions.dates import bucket_date, previous_window
from shelfline.plans import reports
from shelfline.sources.sample_views import SampleTables
from pyspark.sql import functions as F

START, END = "1997-01-01", "1997-03-31"


@pytest.fixture(scope="module")
def tables(spark):
    tables = SampleTables(spark, "/root/testdata/sf0.001")
    tables.transactions.cache()
    return tables


def _sum(rows, *keys):
    out = defaultdict(float)
    for r in rows:
        out[tuple(r[k] for k in keys)] += r.revenue
    return {k: round(v, 2) for k, v in out.items()}


def test_weeks_and_months_are_sums_of_days(tables):
    days = reports.sales_over_time(tables, START, END, "day", "region").collect()
    for grain, first in (("week", lambda d: d - timedelta(days=d.weekday())),
                         ("month", lambda d: d.replace(day=1))):
        coarse = reports.sales_over_time(tables, START, END, grain, "region").collect()
        rolled = defaultdict(float)
        for r in days:
            rolled[first(date.fromisoformat(r.bucket)).isoformat(), r.region] += r.revenue
        assert {k: round(v, 2) for k, v in rolled.items()} == _sum(coarse, "bucket", "region")


def test_two_windows_make_one(tables):
    before = previous_window(START, END)
    assert before == (date(1996, 10, 3), date(1996, 12, 31))
    parts = [reports.kpi_summary(tables, *w).first() for w in ((START, END), before)]
    whole = reports.kpi_summary(tables, before[0], END).first()
    for column in ("total_revenue", "total_units_sold", "ai_rescued_revenue"):
        assert round(sum(p[column] for p in parts), 2) == whole[column]


def test_every_rollup_has_the_same_total(tables):
    total = reports.kpi_summary(tables, START, END).first()
    for frame in ([reports.sales_by_dimension(tables, START, END, d)
                   for d in reports.SALES_DIMENSIONS]
                  + [reports.category_breakdown(tables, START, END),
                     reports.product_scatter(tables, START, END),
                     reports.category_mix_by_channel(tables, START, END),
                     reports.revenue_vs_cost(tables, START, END, "day"),
                     reports.daily_sales_velocity(tables, START, END)]):
        rows = frame.collect()
        assert round(sum(r.revenue for r in rows), 2) == total.total_revenue
        if "units_sold" in frame.columns:
            assert sum(r.units_sold for r in rows) == total.total_units_sold


def test_shares_and_pairs_are_bounded(tables):
    mix = reports.category_mix_by_channel(tables, START, END).collect()
    for channel in {r.channel for r in mix}:
        assert abs(sum(r.share_pct for r in mix if r.channel == channel) - 100) <= 0.5
    orders = reports.sales_by_dimension(tables, START, END, "channel").collect()
    pairs = reports.product_pairs(tables, START, END).collect()
    assert max(r.co_occurrences for r in pairs) <= sum(r.orders for r in orders)


def test_bucket_starts(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2024-03-04')) AS d").select(
        "d", bucket_date(F.col("d"), "week").alias("w"), bucket_date(F.col("d"), "month").alias("m"),
        bucket_date(F.col("d"), "day").alias("same")).collect()
    for r in days:
        assert r.w == r.d - timedelta(days=r.d.weekday())
        assert r.m == r.d.replace(day=1) and r.same == r.d
