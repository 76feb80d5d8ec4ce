"""Files in, files out: readers, staging, the clean table, a whole run, streams."""

import json

import pytest
from pyspark.sql import functions as F

import shop
from shelfline import schemas
from shelfline.plans import clean_run, reports
from shelfline.sources import raw, staging, tables
from shelfline.streaming import ingest

HEADER = "transaction_id,store_id,timestamp_raw,upc_or_name,quantity,price_charged_cents\n"
POS_ROWS = [
    "POS-1,ST001,2026-03-02 10:00:00,000000000001,2,300",
    "POS-2,ST002,03/03/2026 11:30,COLA 12PK,1,699",
    "POS-2,ST002,03/03/2026 11:30,COLA 12PK,5,699",
    "POS-3,,2026-03-04 09:00:00,000000000004,1,348",
    "POS-4,ST001,2026-03-04 09:00:00,MYSTERY,1,100",
    "POS-5,ST001,yesterday,000000000004,1,348",
]
ORDERS = [
    {"order_id": "WM-1", "placed_at": "2026-04-05T10:00:00Z",
     "customer": {"id": "c1", "loyalty_tier": "plus"},
     "items": [{"sku": "000000000001", "qty": 1, "unit_price_cents": 350, "promo_code": None},
               {"sku": "000000000002", "qty": 2, "unit_price_cents": 700, "promo_code": "X"}],
     "fulfillment": "delivery", "store_id": None},
    {"order_id": "WM-2", "placed_at": "2026-04-06T10:00:00Z",
     "customer": {"id": "c2", "loyalty_tier": None}, "items": [],
     "fulfillment": "pickup", "store_id": "ST002"},
]


@pytest.fixture
def shop_dir(spark, tmp_path):
    """Raw files and reference tables in a fresh directory."""
    (tmp_path / "pos.csv").write_text(HEADER + "\n".join(POS_ROWS) + "\n")
    (tmp_path / "orders.jsonl").write_text("\n".join(json.dumps(o) for o in ORDERS))
    (tmp_path / "orders.json").write_text(json.dumps(ORDERS, indent=2))
    spark.createDataFrame(shop.PRODUCTS, schemas.PRODUCTS).write.parquet(str(tmp_path / "out/products"))
    spark.createDataFrame(shop.STORES, schemas.STORES).write.parquet(str(tmp_path / "out/stores"))
    return tmp_path


def test_csv_keeps_leading_zeros_and_file_order(spark, shop_dir):
    df = raw.read_pos_csv(spark, str(shop_dir / "pos.csv"))
    assert df.drop("ingest_order").schema == schemas.RAW_POS
    rows = df.orderBy("ingest_order").collect()
    assert [r.transaction_id for r in rows] == [r.split(",")[0] for r in POS_ROWS]
    assert rows[0].upc_or_name == "000000000001"
    assert rows[3].store_id is None


@pytest.mark.parametrize("name, is_array", [("orders.jsonl", False), ("orders.json", True)])
def test_json_lines_and_json_array(spark, shop_dir, name, is_array):
    df = raw.read_orders_json(spark, str(shop_dir / name), json_array=is_array)
    rows = df.orderBy("order_id").collect()
    assert [len(r["items"]) for r in rows] == [2, 0]
    flat = raw.flatten_customer(df).orderBy("order_id").first()
    assert (flat.customer_id, flat.loyalty_tier) == ("c1", "plus")
    assert flat["items"][1].promo_code == "X"


def test_staging_adds_when_and_where(spark, shop_dir):
    path = str(shop_dir / "stage")
    staging.stage_pos(raw.read_pos_csv(spark, str(shop_dir / "pos.csv")), path)
    staging.stage_pos(raw.read_pos_csv(spark, str(shop_dir / "pos.csv")), path)
    staged = staging.read_staged(spark, path)
    assert staged.count() == 2 * len(POS_ROWS)
    assert staged.where("ingested_at is null").count() == 0
    assert staged.select("ingest_order").distinct().count() == 2 * len(POS_ROWS)


@pytest.mark.parametrize("name, is_array", [("orders.jsonl", False), ("orders.json", True)])
def test_whole_run(spark, shop_dir, name, is_array):
    root = str(shop_dir / "out")
    for _ in range(2):      # a second run replaces the first
        summary = clean_run.run(spark, str(shop_dir / "pos.csv"), str(shop_dir / name), root,
                                json_array=is_array)
        metrics = {r.metric: r.value for r in summary.collect()}
        assert metrics["raw_pos_rows"] == 6 and metrics["raw_orders"] == 2
        assert metrics["duplicates_removed"] == 1
        assert metrics["unknown_rows_dropped"] == 1 and metrics["bad_time_rows_dropped"] == 1
        assert metrics["final_rows"] == 5
        clean = clean_run.read_run(spark, root)
        assert clean.count() == 5
    cola = clean.where("transaction_id = 'POS-2'").first()
    assert (cola.product_id, cola.quantity) == ("000000000002", 1)
    assert {str(r.sale_month) for r in clean.select("sale_month").collect()} \
        == {"2026-03-01", "2026-04-01"}
    rejects = {r.transaction_id: r.outcome for r in clean_run.read_rejects(spark, root).collect()}
    assert rejects == {"POS-4": "unknown_product", "POS-5": "bad_time"}
    aliases = spark.read.parquet(f"{root}/product_alias").collect()
    assert [(a.identifier, a.product_id) for a in aliases] == [("COLA 12PK", "000000000002")]


def test_strict_run_stops_at_a_bad_time(spark, shop_dir):
    with pytest.raises(Exception, match="unreadable time"):
        clean_run.run(spark, str(shop_dir / "pos.csv"), str(shop_dir / "orders.jsonl"),
                      str(shop_dir / "out"), on_error="fail")


def test_clean_table_round_trip(spark, tmp_path):
    source = shop.tables(spark)
    path = str(tmp_path / "transactions")
    assert tables.write_transactions(source.transactions, path) == len(shop.SALES)
    assert tables.write_transactions(source.transactions, path, mode="append") == len(shop.SALES)
    assert tables.write_transactions(source.transactions, path) == len(shop.SALES)
    stored = tables.read_transactions(spark, path)
    assert stored.drop("inserted_at", "sale_month").orderBy("transaction_id", "product_id").collect() \
        == source.transactions.drop("inserted_at").orderBy("transaction_id", "product_id").collect()


def test_a_window_reads_its_months_only(spark, tmp_path):
    source = shop.tables(spark)
    path = str(tmp_path / "transactions")
    tables.write_transactions(source.transactions, path)
    kept = tables.Tables(tables.read_transactions(spark, path), source.products, source.stores,
                         source.forecasts, source.raw_pos)
    df = reports.category_breakdown(kept, "2026-02-01", "2026-02-28")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "sale_month" in scan[:scan.index("PushedFilters")]
    assert "GreaterThanOrEqual(sale_date,2026-02-01)" in scan
    assert "customer_id" not in plan        # columns a report does not use are not read
    assert len(df.inputFiles()) > 0
    assert {r.category for r in df.collect()} == {"Drinks", "Snacks"}


def test_stream_equals_batch(spark, shop_dir):
    pos_dir, order_dir = shop_dir / "pos_in", shop_dir / "orders_in"
    pos_dir.mkdir()
    order_dir.mkdir()
    root = str(shop_dir / "out")
    half = len(POS_ROWS) // 2

    def deliver(n, pos_rows, orders):
        (pos_dir / f"{n}.csv").write_text(HEADER + "\n".join(pos_rows) + "\n")
        (order_dir / f"{n}.json").write_text("\n".join(json.dumps(o) for o in orders))
        query = ingest.start(spark, str(pos_dir), str(order_dir), root, late_by="90 days",
                             availableNow=True)
        query.awaitTermination(300)
        assert query.exception() is None

    deliver(1, POS_ROWS[:half], ORDERS[:1])
    # Copies arrive again in a later delivery.
    deliver(2, POS_ROWS[half:] + POS_ROWS[:2], ORDERS)
    loaded = ingest.read_stream_output(spark, root)
    got = sorted(r.transaction_id for r in loaded.collect())
    assert got == ["ECOM-WM-1-0", "ECOM-WM-1-1", "POS-1", "POS-2", "POS-3"]
    row = loaded.where("transaction_id = 'ECOM-WM-1-1'").first()
    assert (row.store_id, row.region, row.product_name) == ("FC-EAST", "Northeast", "Cola 12pk")
    assert loaded.agg(F.max("inserted_at")).first()[0] is not None

    # Every line is either loaded, rejected with a reason, or a copy.
    rejects = ingest.read_stream_rejects(spark, root)
    assert {(r.transaction_id, r.outcome) for r in rejects.collect()} == {
        ("POS-4", "unknown_product"), ("POS-5", "bad_time")}


def test_stream_remembers_what_the_scorer_found(spark, shop_dir):
    pos_dir, order_dir = shop_dir / "pos_in", shop_dir / "orders_in"
    pos_dir.mkdir()
    order_dir.mkdir()
    (pos_dir / "1.csv").write_text(HEADER + "\n".join(POS_ROWS) + "\n")
    root = str(shop_dir / "out")

    def scorer(batches):
        for batch in batches:
            yield batch.assign(product_id="000000000005", score=0.6)

    ingest.start(spark, str(pos_dir), str(order_dir), root, "90 days", scorer,
                 availableNow=True).awaitTermination(300)
    loaded = {r.transaction_id: r.product_id
              for r in ingest.read_stream_output(spark, root).collect()}
    assert loaded["POS-4"] == "000000000005"
    known = {r.identifier: r.product_id
             for r in spark.read.parquet(f"{root}/product_alias").collect()}
    assert known == {"COLA 12PK": "000000000002", "MYSTERY": "000000000005"}
