"""Loads on top of each other against one run over all their files."""

import json
from pathlib import Path

import pytest

import shop
from shelfline import schemas
from shelfline.plans import clean_run
from shelfline.sources import line_store

HEADER = ",".join(schemas.RAW_POS.names)
FIRST = [
    "POS-1,ST001,2026-02-27 10:00:00,000000000001,2,300",
    "POS-2,ST002,2026-03-03 11:30:00,COLA 12PK,1,699",
    "POS-3,,2026-03-04 09:00:00,000000000004,1,348",
    "POS-4,ST001,2026-03-05 09:00:00,MYSTERY,1,100",
    "POS-5,ST001,yesterday,000000000004,1,348",
]
SECOND = [
    "POS-2,ST002,2026-03-03 11:30:00,COLA 12PK,7,1",        # a copy with another price
    "POS-2,ST002,2026-03-03 11:30:00,COLA 12PK,8,2",
    "POS-2,ST002,2026-03-03 11:30:00,000000000002,1,699",   # another string: no copy
    "POS-3,,2026-03-04 09:00:00,000000000004,9,9",          # a null in the key
    "POS-4,ST001,2026-03-05 09:00:00,MYSTERY,1,100",
    "POS-6,ST001,2026-04-02 09:00:00,000000000005,1,20",
]
THIRD = ["POS-6,ST001,2026-04-02 09:00:00,000000000005,3,3",
         "POS-1,ST001,2026-04-09 10:00:00,000000000001,2,300",  # POS-1 under another month
         "POS-5,ST001,2026-04-10 10:00:00,000000000004,1,348"]  # once unreadable


def _order(number, store, day="2026-03-06"):
    return json.dumps({"order_id": f"WM-{number}", "placed_at": f"{day}T10:00:00Z",
                       "customer": {"id": "c1", "loyalty_tier": None},
                       "items": [{"sku": "000000000001", "qty": 1, "unit_price_cents": 350}],
                       "fulfillment": "delivery", "store_id": store})


ORDERS = [[_order(1, None), _order(2, "ST001")],
          [_order(1, None), _order(1, "FC-EAST"), _order(2, "ST001"), _order(3, None)],
          [_order(3, None)]]


@pytest.fixture
def place(spark, tmp_path):
    for n, (pos, orders) in enumerate(zip((FIRST, SECOND, THIRD), ORDERS)):
        (tmp_path / f"pos{n}.csv").write_text("\n".join([HEADER, *pos]) + "\n")
        (tmp_path / f"orders{n}.jsonl").write_text("\n".join(orders))
    for root in ("whole", "loads"):
        spark.createDataFrame(shop.PRODUCTS, schemas.PRODUCTS).write.parquet(
            str(tmp_path / root / "products"))
        spark.createDataFrame(shop.STORES, schemas.STORES).write.parquet(
            str(tmp_path / root / "stores"))
    return tmp_path


def _load(spark, place, n, **options):
    summary = clean_run.load(spark, str(place / f"pos{n}.csv"), str(place / f"orders{n}.jsonl"),
                             str(place / "loads"), **options)
    return {r.metric: r.value for r in summary.collect()}


def _whole(spark, place, many):
    clean_run.run(spark, [str(place / f"pos{n}.csv") for n in range(many)],
                  [str(place / f"orders{n}.jsonl") for n in range(many)], str(place / "whole"))
    return spark.read.parquet(str(place / "whole/sale_lines"))


def _rows(df):
    columns = [c for c in schemas.TRANSACTION_COLUMNS] + ["copies", "routed", "outcome"]
    return sorted(map(str, df.select(*columns).collect()))


def _files(place):
    return {str(p.relative_to(place)): p.stat().st_mtime_ns
            for p in (place / "loads/lines").rglob("*.parquet")}


def test_two_loads_equal_one_run(spark, place):
    root = str(place / "loads")
    one = _load(spark, place, 0)
    assert (one["lines_added"], one["run"]) == (7, 1)
    before = _files(place)
    two = _load(spark, place, 1)
    assert (two["lines_added"], two["run"], two["months_written"]) == (4, 2, 2)
    assert _rows(line_store.read_lines(spark, root)) == _rows(_whole(spark, place, 2))
    clean = clean_run.read_loaded(spark, root)
    assert clean.where("transaction_id = 'POS-2' and quantity = 1").count() == 2
    # The files of the first load are as they were, and only March and April are new.
    after = _files(place)
    assert {k: v for k, v in after.items() if k in before} == before
    assert {f.split("/")[3] for f in set(after) - set(before)} \
        == {"sale_month=2026-03-01", "sale_month=2026-04-01"}
    held = {str(m): n for m, n in line_store.snapshot(spark, root).items()}
    assert held == {"2026-02-01": 1, "2026-03-01": 2, "2026-04-01": 2, "None": 1}
    # A load is still there after the next one.
    assert line_store.read_lines(spark, root, 1).count() == 7


def test_copies_under_another_month(spark, place):
    root = str(place / "loads")
    for n in range(2):
        _load(spark, place, n)
    three = _load(spark, place, 2, everywhere=True)
    assert three["lines_added"] == 0 and three["months_written"] == 4
    assert _rows(line_store.read_lines(spark, root)) == _rows(_whole(spark, place, 3))


def test_the_same_load_again_adds_nothing(spark, place):
    _load(spark, place, 0)
    lines = line_store.read_lines(spark, str(place / "loads")).count()
    again = _load(spark, place, 0)
    assert again["lines_added"] == 0
    stored = line_store.read_lines(spark, str(place / "loads"))
    assert stored.count() == lines and stored.where("copies <> 2").count() == 0


def test_a_failed_load_leaves_the_table(spark, place, monkeypatch):
    root = str(place / "loads")
    _load(spark, place, 0)
    before = _rows(line_store.read_lines(spark, root))
    with monkeypatch.context() as broken:
        broken.setattr(line_store, "_write_snapshot", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _load(spark, place, 1)
    assert line_store.runs(spark, root) == [1] and line_store.next_run(spark, root) == 3
    assert _rows(line_store.read_lines(spark, root)) == before
    # A snapshot that was begun and not finished does not count.
    Path(root, "snapshots/run=7").mkdir()
    assert _load(spark, place, 1)["run"] == 8
    assert _rows(line_store.read_lines(spark, root)) == _rows(_whole(spark, place, 2))


def test_expire(spark, place):
    root = str(place / "loads")
    for n in range(3):
        _load(spark, place, n)
    before = _rows(line_store.read_lines(spark, root))
    gone = line_store.expire(spark, root, keep=1)
    assert len(gone) == 5    # two snapshots, March of two loads, April of the second
    assert _rows(line_store.read_lines(spark, root)) == before
    assert line_store.expire(spark, root, keep=1) == []
    with pytest.raises(ValueError):
        line_store.read_lines(spark, root, 1)
    with pytest.raises(ValueError):
        line_store.expire(spark, root, keep=0)


def test_a_filter_reads_its_months_only(spark, place):
    _load(spark, place, 0)
    march = line_store.read_lines(spark, str(place / "loads")).where(
        "sale_month = date'2026-03-01' and outcome = 'loaded'")
    assert "sale_month" in march._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters")[1].split("]")[0]
    assert march.count() == 4


def test_nothing_loaded(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing was loaded"):
        line_store.read_lines(spark, str(tmp_path))
