from datetime import datetime

import pytest
from pyspark.sql import functions as F

import shop
from shelfline import schemas
from shelfline.operators import cleaning, enrich, quality
from shelfline.plans import clean_run

ORDERS = [
    ("A", "2026-03-04T12:00:00Z", "c1", "basic",
     [("000000000001", 1, 350, None), ("000000000002", 2, 700, "SPRING")], "delivery", None, 1),
    ("B", "2026-03-04T23:30:00-05:00", "c2", None, [("000000000003", 1, 400, None)],
     "pickup", "ST002", 2),
    ("C", "2026-03-04T12:00:00Z", "c3", None, [], "ship", None, 3),
    ("D", "2026-03-04T12:00:00", "c4", None, [("000000000003", 1, 400, None)], "ship", None, 4),
]
ORDER_SCHEMA = ("order_id string, placed_at string, customer_id string, loyalty_tier string, "
                "items array<struct<sku string, qty int, unit_price_cents int, promo_code string>>, "
                "fulfillment string, store_id string, ingest_order int")

POS = [
    ("T1", "ST001", "2026-03-02 10:00:00", "000000000001", 2, 300, 1),
    ("T2", "ST001", "3/5/2026 4:02", "CL 12PK", 1, 699, 2),
    # A copy with another quantity: the first one counts.
    ("T1", "ST001", "2026-03-02 10:00:00", "000000000001", 9, 300, 3),
    # Null store and null identifier; null keys compare equal.
    ("T3", None, "2026-03-02 10:00:00", None, 1, 100, 4),
    ("T3", None, "2026-03-02 10:00:00", None, 1, 100, 5),
    # The same id with another product is another line.
    ("T1", "ST001", "2026-03-02 10:00:00", "000000000004", 1, 348, 6),
    ("T4", "ST001", "not a time", "000000000001", 1, 300, 7),
    ("T5", "ST001", "2026-03-02 10:00:00", "SOMETHING ELSE", 1, 300, 8),
    ("T6", "ST001", "2026-03-02 10:00:00", "999999999999", 1, 300, 9),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, ORDER_SCHEMA)


@pytest.fixture(scope="module")
def pos(spark):
    return spark.createDataFrame(
        POS, "transaction_id string, store_id string, timestamp_raw string, upc_or_name string, "
             "quantity int, price_charged_cents int, ingest_order int")


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(shop.PRODUCTS, schemas.PRODUCTS)


@pytest.fixture(scope="module")
def stores(spark):
    return spark.createDataFrame(shop.STORES, schemas.STORES)


def test_explode_orders(orders):
    rows = {r.transaction_id: r for r in cleaning.explode_orders(orders).collect()}
    assert set(rows) == {"ECOM-A-0", "ECOM-A-1", "ECOM-B-0", "ECOM-D-0"}
    second = rows["ECOM-A-1"]
    assert (second.order_id, second.product_identifier, second.quantity,
            second.sale_price_cents, second.customer_id, second.channel) == (
                "A", "000000000002", 2, 700, "c1", "ecommerce")


def test_union_keeps_every_row(pos, orders):
    lines = cleaning.union_channels(cleaning.normalize_pos(pos), cleaning.explode_orders(orders))
    assert lines.count() == len(POS) + 4
    register = lines.where("channel = 'pos'")
    assert register.where("order_id = transaction_id and customer_id is null").count() == len(POS)


@pytest.mark.parametrize("raw, expected", [
    ("2026-03-02 10:00:00", "2026-03-02 10:00:00"),
    ("2026-3-2 4:05:06", "2026-03-02 04:05:06"),
    ("03/05/2026 04:02", "2026-03-05 04:02:00"),
    ("3/5/2026 4:02", "2026-03-05 04:02:00"),
    ("2026-03-15T14:22:10Z", "2026-03-15 14:22:10"),
    ("2026-03-15T23:30:00-05:00", "2026-03-16 04:30:00"),
    ("2026-03-15T04:00:00+05:30", "2026-03-14 22:30:00"),
    ("2026-03-15T14:22Z", "2026-03-15 14:22:00"),
    ("2026-03-15T14:22+0200", "2026-03-15 12:22:00"),
    ("2026-03-15T14:22:10z", "2026-03-15 14:22:10"),
    ("20260315T142210Z", "2026-03-15 14:22:10"),
    ("20260315T1422Z", "2026-03-15 14:22:00"),
    ("2026-03-15T14:22:10.5Z", "2026-03-15 14:22:10"),
    ("2026-03-15T14:22:10", None),        # no offset: not decidable
    ("2026-03-15", None),
    ("15/03/2026 10:00", None),
    ("2026-13-01 10:00:00", None),
    ("2026-02-30 10:00:00", None),
    ("", None),
    (None, None),
])
def test_parse_time(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "sale_timestamp_raw string")
    row = cleaning.parse_timestamps(df).select(
        F.date_format("sale_timestamp", "yyyy-MM-dd HH:mm:ss").alias("t"), "sale_date").first()
    assert row.t == expected
    assert str(row.sale_date) == (expected[:10] if expected else "None")


def test_unreadable_time_can_stop_the_run(pos):
    lines = cleaning.parse_timestamps(cleaning.normalize_pos(pos), on_error="fail")
    with pytest.raises(Exception, match="unreadable time: not a time"):
        lines.select("sale_timestamp").collect()
    with pytest.raises(ValueError):
        cleaning.parse_timestamps(lines, on_error="ignore")


def test_keep_first_copy(spark, pos):
    lines = cleaning.normalize_pos(pos)
    kept = cleaning.keep_first_copy(lines.repartition(5))
    rows = {(r.transaction_id, r.product_identifier): r for r in kept.collect()}
    assert len(rows) == 7
    assert (rows["T1", "000000000001"].quantity, rows["T1", "000000000001"].copies) == (2, 2)
    assert rows["T3", None].copies == 2
    again = cleaning.keep_first_copy(kept.drop("copies"))
    assert sorted(map(str, again.drop("copies").collect())) \
        == sorted(map(str, kept.drop("copies").collect()))


def test_one_line_sent_very_often_shrinks_before_the_shuffle(spark):
    # A third of all rows are copies of one line.
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("T"), F.col("id").cast("string"))).alias("transaction_id"),
        F.lit("p").alias("product_identifier"), F.lit("s").alias("store_id"),
        F.col("id").alias("payload"), F.col("id").alias("ingest_order"))
    kept = cleaning.keep_first_copy(rows)
    assert kept.count() == 60_001
    hot = kept.where("transaction_id = 'HOT'").first()
    assert (hot.payload, hot.copies) == (0, 30_000)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan and "ShuffledHashJoin" in plan


def test_route_missing_stores(pos, orders):
    lines = cleaning.clean_lines(pos, orders)
    stores = {r.transaction_id: r.store_id for r in lines.collect()}
    assert stores["ECOM-A-0"] == "FC-EAST"
    assert stores["ECOM-B-0"] == "ST002"
    assert stores["T3"] is None


def test_unmatched_identifiers(pos, products):
    found = cleaning.unmatched_identifiers(cleaning.normalize_pos(pos), products)
    assert {r.identifier for r in found.collect()} == {
        "CL 12PK", "SOMETHING ELSE", "999999999999"}


def test_build_transactions(pos, orders, products, stores):
    rows = {r.transaction_id + r.product_id: r for r in clean_run.build_transactions(
        pos, orders, products, stores).collect()}
    assert set(rows) == {
        "T1000000000001", "T1000000000004", "T2000000000002",
        "ECOM-A-0000000000001", "ECOM-A-1000000000002", "ECOM-B-0000000000003"}
    named = rows["T2000000000002"]
    assert (named.product_name, named.category, named.region) == ("Cola 12pk", "Drinks", "South")
    assert (str(named.unit_price), str(named.sale_price)) == ("4.00", "6.99")
    assert named.sale_timestamp == datetime(2026, 3, 5, 4, 2)
    late = rows["ECOM-B-0000000000003"]
    assert str(late.sale_date) == "2026-03-05"      # 23:30 in New York is the next day in UTC
    assert rows["ECOM-A-0000000000001"].region == "Northeast"


def test_run_summary_and_reconciliation(pos, orders, products):
    resolution = clean_run.resolve(pos, orders, products)
    lines = clean_run.classified_lines(pos, orders, products, resolution)
    summary = clean_run.run_summary(lines, orders, resolution)
    metrics = {r.metric: r.value for r in summary.collect()}
    assert metrics == {
        "raw_pos_rows": 9, "raw_orders": 4, "exploded_lines": 4,
        "lines_after_dedup": 11, "duplicates_removed": 2, "routed_to_fulfillment": 3,
        "unmatched_identifiers": 3, "resolutions_made": 1,
        "unknown_rows_dropped": 3, "bad_time_rows_dropped": 2, "final_rows": 6}
    assert all(r.difference == 0 for r in quality.reconcile(summary).collect())


def test_unlisted_store_keeps_the_line(spark, stores):
    lines = spark.createDataFrame([("x", "ST777"), ("y", None)], "id string, store_id string")
    assert [r.region for r in enrich.join_stores(lines, stores).collect()] == [None, None]


def test_quality_checks(spark):
    tables = shop.tables(spark)
    tx = tables.transactions
    assert quality.null_violations(tx).count() == 0
    holes = tx.withColumn("store_id", F.when(F.col("transaction_id") != "POS-1", F.col("store_id"))) \
        .withColumn("category", F.when(F.col("transaction_id") != "POS-1", F.col("category")))
    assert {tuple(r) for r in quality.null_violations(holes).collect()} == {
        ("POS-1", "store_id"), ("POS-1", "category")}
    assert quality.pk_violations(tx).count() == 0
    assert quality.pk_violations(tx.union(tx.limit(1))).first().copies == 2
    assert quality.domain_violations(tx).count() == 0
    assert quality.domain_violations(tx, "channel", ("pos",)).count() == 8
    assert quality.domain_violations(
        tx.withColumn("channel", F.lit(None).cast("string"))).count() == 0
    assert quality.fk_violations(tables.forecasts, tables.products, "product_id").count() == 1
    assert quality.fk_violations(tables.forecasts, tables.stores, "store_id").count() == 1
    assert quality.fk_violations(holes, tables.stores, "store_id").count() == 0
