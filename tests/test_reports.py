"""Reports on the hand-written shop, with results worked out by hand."""

import pytest

import shop
from shelfline.plans import adhoc, derived, reports
from shelfline.sources.tables import freshness
from shop import END, P1, P2, P3, P4, P5, START


@pytest.fixture(scope="module")
def tables(spark):
    return shop.tables(spark)


def got(df):
    return [tuple(r) for r in df.collect()]


def test_describe(tables):
    row = reports.describe_data(tables).first()
    assert (row.window_start, row.window_end) == ("2026-02-19", "2026-03-12")
    assert row.channels == ["ecommerce", "pos"]
    assert row.regions == ["Midwest", "Northeast", "South"]
    assert row.categories == ["Dairy", "Drinks", "Promo", "Snacks"]
    assert (row.total_transactions, row.total_products) == (15, 5)
    assert reports.describe_stores(tables).count() == 4


def test_kpi(tables):
    row = reports.kpi_summary(tables, START, END).first()
    # 6 + 6.99 + 6 + 3.5 + 14 + 3.48 + 3.5 + 7 + 6.96 + 12 + 0
    assert row.total_revenue == 69.43
    assert row.total_units_sold == 16
    assert row.average_order_value == round(69.43 / 8, 2)
    # POS-2 was named in words, POS-3 had no identifier at all.
    assert row.ai_rescued_revenue == 12.99
    assert row.ai_rescued_revenue_pct == 18.71


def test_kpi_of_an_empty_window_is_zero(tables):
    assert got(reports.kpi_summary(tables, "2030-01-01", "2030-01-31")) == [(0.0, 0, 0.0, 0.0, 0.0)]


def test_sales_over_time(tables):
    weekly = got(reports.sales_over_time(tables, START, END, "week", "channel"))
    assert weekly == [
        ("2026-03-02", "ecommerce", 20.98), ("2026-03-02", "pos", 12.99),
        ("2026-03-09", "ecommerce", 29.46), ("2026-03-09", "pos", 6.0)]
    # A week bucket may begin before the window.
    assert got(reports.sales_over_time(tables, "2026-03-03", "2026-03-03", "week", "channel")) \
        == [("2026-03-02", "pos", 6.99)]
    monthly = got(reports.sales_over_time(tables, START, END, "month", "region"))
    # POS-3 was sold in a store without a region and is in no region.
    assert monthly == [("2026-03-01", "Midwest", 6.99), ("2026-03-01", "Northeast", 43.48),
                       ("2026-03-01", "South", 12.96)]
    daily = got(reports.sales_over_time(tables, START, END, "day", "store_id"))
    assert ("2026-03-10", "ST001", 6.96) in daily


def test_sales_by_dimension(tables):
    assert got(reports.sales_by_dimension(tables, START, END, "channel")) == [
        ("ecommerce", 50.44, 11, 4), ("pos", 18.99, 5, 4)]
    assert [r[0] for r in got(reports.sales_by_dimension(tables, START, END, "region"))] == [
        "Northeast", "South", "Midwest"]
    assert got(reports.sales_by_dimension(tables, "2030-01-01", "2030-01-31", "region")) == []


def test_top_products_and_growth(tables):
    assert [r[0] for r in got(reports.top_products(tables, START, END, 2))] == [P2, P1]
    rows = {r.product_id: r for r in
            reports.top_products(tables, START, END, 10, with_growth=True).collect()}
    # The earlier window is 02-20 .. 03-01: P1 was sold on 02-19 only.
    assert (rows[P2].revenue, rows[P2].prior_revenue, rows[P2].growth_pct) == (33.99, 5.0, 579.8)
    assert (rows[P1].prior_revenue, rows[P1].growth_pct) == (0.0, None)
    drinks = got(reports.top_products(tables, START, END, 10, category="Drinks"))
    assert [r[0] for r in drinks] == [P2, P3]
    assert got(reports.top_products(tables, START, END, 10, category="")) \
        == got(reports.top_products(tables, START, END, 10))


def test_forecast_vs_actual(tables):
    by_category = {r.category: r for r in
                   reports.forecast_vs_actual(tables, START, END, "category").collect()}
    snacks = by_category["Snacks"]
    assert (snacks.forecasted_revenue, snacks.forecasted_units) == (12.0, 4)
    assert (snacks.actual_revenue, snacks.actual_units, snacks.revenue_delta_pct) == (13.0, 4, 8.3)
    # Sold without a forecast, and forecast with no money: no percentage.
    assert by_category["Promo"].forecasted_revenue == 0.0
    assert by_category["Promo"].revenue_delta_pct is None
    assert by_category["Dairy"].revenue_delta_pct is None
    assert set(by_category) == {"Snacks", "Drinks", "Dairy", "Promo"}
    # Unknown products and stores count in the overall figure only.
    overall = reports.forecast_vs_actual(tables, START, END, "overall").first()
    assert (overall.forecasted_revenue, overall.forecasted_units) == (40.0, 11)
    assert overall.revenue_delta_pct == 73.6
    by_product = {r.product_id: r for r in
                  reports.forecast_vs_actual(tables, START, END, "product_id").collect()}
    assert by_product["999999999999"].actual_units == 0
    assert by_product["999999999999"].revenue_delta_pct == -100.0
    by_region = {r.region for r in
                 reports.forecast_vs_actual(tables, START, END, "region").collect()}
    assert by_region == {"South", "Midwest", "Northeast"}
    # No forecast week in the window: nothing, although there are sales.
    for dimension in ("category", "overall"):
        assert got(reports.forecast_vs_actual(tables, "2026-03-03", "2026-03-04", dimension)) == []


def test_product_pairs(tables):
    pairs = got(reports.product_pairs(tables, START, END, 20))
    names = {p[0]: p[1] for p in shop.PRODUCTS}
    assert pairs == [(names[P1], names[P2], 2), (names[P1], names[P4], 1),
                     (names[P2], names[P4], 1)]
    assert got(reports.product_pairs(tables, START, END, 2)) == pairs[:2]


def test_category_mix(tables):
    mix = got(reports.category_mix_by_channel(tables, START, END))
    assert [r[:2] for r in mix] == sorted(r[:2] for r in mix)
    for channel in ("pos", "ecommerce"):
        assert abs(sum(r[3] for r in mix if r[0] == channel) - 100) <= 0.2
    pivot = {r.category: r for r in derived.category_mix_pivot(tables, START, END).collect()}
    assert (pivot["Dairy"].pos, pivot["Promo"].ecommerce) == (0.0, 0.0)


def test_revenue_vs_cost(tables):
    rows = got(reports.revenue_vs_cost(tables, START, END, "week"))
    # Costs: 4 + 4 + 2 + 8 + 2.2, then 4 + 2 + 4 + 4.4 + 7.5 + 0.1
    assert rows == [("2026-03-02", 33.97, 20.2, 13.77, 40.5),
                    ("2026-03-09", 35.46, 22.0, 13.46, 38.0)]


def test_product_margins(tables):
    rows = {r.product_id: r for r in reports.product_margins(tables, START, END).collect()}
    # A plain mean over lines: (1.00 + 1.50 + 1.50) / 3.
    assert rows[P1].margin_per_unit == 1.33
    assert (rows[P1].units_sold, rows[P1].revenue, rows[P1].total_margin) == (4, 13.0, 5.0)
    assert rows[P1].margin_pct == 38.5
    assert (rows[P5].total_margin, rows[P5].margin_pct) == (-0.1, None)
    top = got(reports.product_margins(tables, START, END, 1))
    assert [r[0] for r in top] == [P2]


def test_category_breakdown_and_top_margin(tables):
    rows = {r.category: r for r in reports.category_breakdown(tables, START, END).collect()}
    assert (rows["Drinks"].revenue, rows["Drinks"].wholesale_cost) == (45.99, 27.5)
    assert (rows["Drinks"].units_sold, rows["Drinks"].product_count) == (8, 2)
    flagged = derived.category_top_margin(tables, START, END).collect()
    assert [r.category for r in flagged if r.is_top_margin] == ["Drinks"]
    assert {r.total_revenue for r in flagged} == {69.43}


def test_daily_velocity(tables):
    rows = got(reports.daily_sales_velocity(tables, START, END))
    assert len(rows) == 10
    assert rows[0] == ("2026-03-02", 2, 6.0)
    assert ("2026-03-05", 0, 0.0) in rows
    assert got(reports.daily_sales_velocity(tables, END, START)) == []
    assert len(got(reports.daily_sales_velocity(tables, "2030-01-01", "2030-01-31"))) == 31


def test_quadrants(tables):
    rows = {r.product_id: r for r in derived.product_quadrants(tables, START, END).collect()}
    # Units 4 5 3 3 1 -> median 3; margins 1.33 2.75 1.50 1.26 -0.10 -> median 1.33.
    assert rows[P2].median_units == 3.0
    assert rows[P2].median_margin == 1.33
    assert {p: rows[p].quadrant for p in rows} == {
        P1: "Stars", P2: "Stars", P3: "Stars", P4: "Workhorses", P5: "Cut candidates"}


def test_rank_direction_search(tables):
    ranked = derived.ranked_top_products(tables, START, END, 3).collect()
    assert [(r["rank"], r.product_id) for r in ranked] == [(1, P2), (2, P1), (3, P3)]
    moves = {r.category: r.direction for r in
             derived.delta_direction(tables, START, END).collect()}
    assert moves["Snacks"] == "up" and moves["Promo"] == "up"
    found = derived.product_search(tables, START, END, "cRaCk").collect()
    assert [(r.product_id, r.match_offset) for r in found] == [(P1, 6)]
    assert got(derived.product_search(tables, START, END, "  ")) == []


def test_calendar_and_freshness(tables):
    rows = {r.sale_date: r for r in derived.sales_calendar(tables, START, END).collect()}
    assert (rows["2026-03-02"].week_row, rows["2026-03-02"].weekday) == (0, 1)
    assert (rows["2026-03-08"].week_row, rows["2026-03-08"].weekday) == (1, 0)
    assert rows["2026-03-10"].level == 5 and rows["2026-03-05"].level == 1
    assert str(freshness(tables.transactions).first()[0]) == "2026-04-21 00:00:00"


def test_adhoc(tables):
    # A missing identifier is not among the rows named in words.
    assert [r.transaction_id for r in adhoc.raw_before(tables).collect()] == ["POS-2", "POS-2"]
    # The join repeats a line as often as it was staged.
    assert len(adhoc.raw_after(tables).collect()) == 2
    assert len(adhoc.raw_after(tables, once=True).collect()) == 1
    assert len(adhoc.raw_after(tables, n=1).collect()) == 1
    rows = adhoc.week_category_region(tables, "2026-03-09", "2026-03-15").collect()
    assert ("Drinks", None, 1, 6.0) in [tuple(r) for r in rows]


@pytest.mark.parametrize("call", [
    lambda t: reports.sales_over_time(t, START, END, "hour", "category"),
    lambda t: reports.sales_over_time(t, START, END, "week", "product_id"),
    lambda t: reports.sales_by_dimension(t, START, END, "planet"),
    lambda t: reports.forecast_vs_actual(t, START, END, "channel"),
    lambda t: reports.revenue_vs_cost(t, START, END, "year"),
    lambda t: reports.top_products(t, START, END, 0),
    lambda t: reports.kpi_summary(t, "not a date", END),
])
def test_bad_arguments_are_refused_before_any_job(tables, call):
    with pytest.raises(ValueError):
        call(tables)


def test_rollups_add_up(tables):
    total = reports.kpi_summary(tables, START, END).first().total_revenue
    for frame in (reports.sales_by_dimension(tables, START, END, "channel"),
                  reports.sales_by_dimension(tables, START, END, "store_id"),
                  reports.category_breakdown(tables, START, END),
                  reports.product_scatter(tables, START, END),
                  reports.daily_sales_velocity(tables, START, END),
                  reports.revenue_vs_cost(tables, START, END, "month")):
        assert round(sum(r.revenue for r in frame.collect()), 2) == total


def test_registry_names_every_report(tables):
    assert len(reports.REPORTS) == 14
    by_name = reports.report("get_kpi_summary", tables, start=START, end=END)
    assert got(by_name) == got(reports.report("kpi_summary", tables, start=START, end=END))
    assert reports.report("describe_data", tables).count() == 1
    with pytest.raises(ValueError):
        reports.report("get_everything", tables)


def test_other_products_are_never_lost(tables):
    assert {r.product_id for r in reports.product_scatter(tables, START, END).collect()} \
        == {P1, P2, P3, P4, P5}
