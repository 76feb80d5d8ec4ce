"""Lines that cannot be used: found, with the reason, in every way they can come in."""

import json

import pytest
from pyspark.sql import functions as F

import shop
from shelfline import schemas
from shelfline.plans import clean_run
from shelfline.sources import raw, staging
from shelfline.streaming import ingest

HEADER = ",".join(schemas.RAW_POS.names)
GOOD = "POS-1,ST001,2026-03-02 10:00:00,000000000001,2,300"
POS = [
    (GOOD, None),
    ("POS-2,,2026-03-02 10:00:00,000000000001,2,300", None),
    ('POS-3,ST001,2026-03-02 10:00:00,"Cola, 12pk",2,300', None),
    ("POS-4,ST001,2026-03-02 10:00:00,000000000001,2", "field count"),
    ("POS-5,ST001,2026-03-02 10:00:00,000000000001,2,300,9", "field count"),
    ("POS-6", "field count"),
    ("POS-7,ST001,2026-03-02 10:00:00,000000000001,two,300", "bad quantity"),
    ("POS-8,ST001,2026-03-02 10:00:00,000000000001,2.5,300", "bad quantity"),
    ("POS-9,ST001,2026-03-02 10:00:00,000000000001,99999999999,300", "bad quantity"),
    ("POS-10,ST001,2026-03-02 10:00:00,000000000001,,300", "missing quantity"),
    ("POS-11,ST001,2026-03-02 10:00:00,000000000001,2,3$", "bad price_charged_cents"),
    (",ST001,2026-03-02 10:00:00,000000000001,2,300", "missing transaction_id"),
]
ORDER = {"order_id": "WM-1", "placed_at": "2026-04-05T10:00:00Z",
         "customer": {"id": "c1", "loyalty_tier": None},
         "items": [{"sku": "000000000001", "qty": 1, "unit_price_cents": 350}],
         "fulfillment": "delivery", "store_id": None}


def _order(**changed):
    return json.dumps({k: v for k, v in {**ORDER, **changed}.items() if v != "gone"})


ITEM = ORDER["items"][0]
ORDERS = [
    (_order(), None),
    (_order(items=[]), None),
    (_order()[:-9], "malformed"),
    ("no json", "malformed"),
    (_order(items=[{**ITEM, "qty": "two"}]), "mistyped"),
    (_order(items="none"), "mistyped"),
    (_order(order_id="gone"), "missing order_id"),
    (_order(items="gone"), "missing items"),
    (_order(items=[ITEM, {"sku": "x"}]), "incomplete item"),
    (_order(items=[ITEM, None]), "incomplete item"),
]


def _reasons(checked):
    return [(r.line, r.reason) for r in checked.orderBy("ingest_order").collect()]


def _wanted(lines):
    return [(line if reason else None, reason) for line, reason in lines]


def _feed(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "place int, line string")


def test_messages(spark):
    more = [("", "missing transaction_id"), (None, "missing transaction_id")]
    feed = _feed(spark, [line for line, _ in POS + more])
    checked = raw.check_pos_lines(feed, "line", "place")
    assert _reasons(checked) == _wanted(POS) + [("", "missing transaction_id")] * 2
    assert raw.parse_pos_lines(feed, "line", "place").count() \
        + raw.rejected(checked).count() == len(POS) + 2
    assert raw.accepted(checked).drop("ingest_order").schema == schemas.RAW_POS
    documents = _feed(spark, [line for line, _ in ORDERS] + ["", None])
    checked = raw.check_order_documents(documents, "line", "place")
    assert _reasons(checked) == _wanted(ORDERS) + [("", "missing order_id")] * 2
    assert raw.accepted(checked).drop("ingest_order").schema == schemas.RAW_ORDERS


@pytest.fixture
def files(spark, tmp_path):
    (tmp_path / "pos.csv").write_text("\n".join([HEADER] + [line for line, _ in POS]) + "\n")
    (tmp_path / "orders.jsonl").write_text("\n".join(line for line, _ in ORDERS))
    spark.createDataFrame(shop.PRODUCTS, schemas.PRODUCTS).write.parquet(str(tmp_path / "out/products"))
    spark.createDataFrame(shop.STORES, schemas.STORES).write.parquet(str(tmp_path / "out/stores"))
    return tmp_path


def test_files(spark, files):
    pos = raw.check_pos_csv(spark, str(files / "pos.csv"))
    assert _reasons(pos) == _wanted(POS)
    assert raw.read_pos_csv(spark, str(files / "pos.csv")).count() == 3
    orders = raw.check_orders_json(spark, str(files / "orders.jsonl"))
    assert [r.reason for r in orders.orderBy("ingest_order").collect()] == [r for _, r in ORDERS]
    for (line, reason), row in zip(ORDERS, orders.orderBy("ingest_order").collect()):
        assert (row.line is None) == (reason is None)
        assert reason not in ("malformed", "mistyped") or row.line == line


def test_a_file_with_another_header_stops_the_job(spark, files):
    (files / "pos.csv").write_text(HEADER.replace("quantity", "amount") + "\n" + GOOD + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_pos_csv(spark, str(files / "pos.csv")).collect()


def test_a_run_keeps_and_counts_them(spark, files):
    root = str(files / "out")
    counters = {r.metric: r.value for r in clean_run.run(
        spark, str(files / "pos.csv"), str(files / "orders.jsonl"), root).collect()}
    assert counters["pos_lines_rejected"] == 9 and counters["orders_rejected"] == 8
    assert counters["raw_pos_rows"] == 3 and counters["raw_orders"] == 2
    kept = staging.read_rejected(spark, f"{root}/raw_pos").collect()
    assert sorted((r.line, r.reason) for r in kept) == sorted(x for x in POS if x[1])


def test_a_stream_keeps_them(spark, files):
    for name, file in (("pos", "pos.csv"), ("orders", "orders.jsonl")):
        (files / name).mkdir()
        (files / file).rename(files / name / file)
    root = str(files / "out")
    for begin in (ingest.start, ingest.start_rejects):
        begin(spark, str(files / "pos"), str(files / "orders"), root,
              availableNow=True).awaitTermination()
    rejects = spark.read.parquet(f"{root}/stream_rejects")
    assert {r.feed: r["count"] for r in rejects.groupBy("feed").count().collect()} \
        == {"pos": 9, "orders": 8}
    assert rejects.where(F.col("line").isNull()).count() == 0
    lines = spark.read.parquet(f"{root}/stream_lines")
    assert lines.count() == 4
