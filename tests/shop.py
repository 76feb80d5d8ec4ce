"""A small hand-written shop with the awkward rows every function must survive."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from shelfline import schemas
from shelfline.sources.tables import Tables

PRODUCTS = [
    ("000000000001", "Plain Crackers 8oz", "Snacks", 200, 1),
    ("000000000002", "Cola 12pk", "Drinks", 400, 2),
    ("000000000003", "Orange Juice 59oz", "Drinks", 250, 2),
    ("000000000004", "Whole Milk 1gal", "Dairy", 220, 3),
    ("000000000005", "Free Sample", "Promo", 10, 3),
]

STORES = [
    ("ST001", "Store One", "Rogers", "AR", "South", "retail"),
    ("ST002", "Store Two", "Chicago", "IL", "Midwest", "retail"),
    ("ST003", "Store Three", "Nowhere", "NA", None, "retail"),
    ("FC-EAST", "Center East", "Bethlehem", "PA", "Northeast", "fulfillment_center"),
]

_BY_ID = {p[0]: p for p in PRODUCTS}
_REGION = {s[0]: s[4] for s in STORES}


def sale(tid, oid, pid, day, qty, price, store, channel, customer=None):
    """One row of `transactions`."""
    product = _BY_ID[pid]
    when = datetime.fromisoformat(day)
    return (tid, oid, pid, product[1], product[2], when.date(), when, qty,
            Decimal(product[3]) / 100, Decimal(str(price)), store, _REGION.get(store),
            customer, channel, datetime(2026, 4, 21))


P1, P2, P3, P4, P5 = (p[0] for p in PRODUCTS)

SALES = [
    # Window 2026-03-02 (Monday) .. 2026-03-11 (Wednesday).
    sale("POS-1", "POS-1", P1, "2026-03-02", 2, "3.00", "ST001", "pos"),
    sale("POS-2", "POS-2", P2, "2026-03-03", 1, "6.99", "ST002", "pos"),
    sale("POS-3", "POS-3", P2, "2026-03-11", 1, "6.00", "ST003", "pos"),
    sale("ECOM-A-0", "A", P1, "2026-03-04", 1, "3.50", "FC-EAST", "ecommerce", "c1"),
    sale("ECOM-A-1", "A", P2, "2026-03-04", 2, "7.00", "FC-EAST", "ecommerce", "c1"),
    sale("ECOM-A-2", "A", P4, "2026-03-04", 1, "3.48", "FC-EAST", "ecommerce", "c1"),
    sale("ECOM-B-0", "B", P1, "2026-03-09", 1, "3.50", "FC-EAST", "ecommerce", "c2"),
    sale("ECOM-B-1", "B", P2, "2026-03-09", 1, "7.00", "FC-EAST", "ecommerce", "c2"),
    # The same product twice and nothing else: no pair.
    sale("ECOM-C-0", "C", P4, "2026-03-10", 1, "3.48", "ST001", "ecommerce", "c3"),
    sale("ECOM-C-1", "C", P4, "2026-03-10", 1, "3.48", "ST001", "ecommerce", "c3"),
    # One line only.
    sale("ECOM-D-0", "D", P3, "2026-03-10", 3, "4.00", "FC-EAST", "ecommerce", "c4"),
    # Given away: a group with no revenue.
    sale("POS-9", "POS-9", P5, "2026-03-10", 1, "0.00", "ST001", "pos"),
    # The ten days before.
    sale("POS-5", "POS-5", P2, "2026-02-20", 1, "5.00", "ST001", "pos"),
    sale("POS-6", "POS-6", P1, "2026-02-19", 9, "3.00", "ST001", "pos"),
    # After.
    sale("POS-7", "POS-7", P1, "2026-03-12", 7, "3.00", "ST001", "pos"),
]
START, END = "2026-03-02", "2026-03-11"

FORECASTS = [
    (1, P1, "ST001", date(2026, 2, 23), 50, Decimal("150.00")),   # Monday before
    (2, P1, "ST001", date(2026, 3, 2), 4, Decimal("12.00")),
    (3, P3, "ST002", date(2026, 3, 9), 5, Decimal("20.00")),
    (4, "999999999999", "ST001", date(2026, 3, 9), 1, Decimal("8.00")),   # unknown product
    (5, P4, "ST999", date(2026, 3, 9), 1, Decimal("0.00")),       # unknown store, no money
]

RAW_POS = [
    ("POS-1", "ST001", "2026-03-02 10:00:00", P1, 2, 300),
    ("POS-2", "ST002", "03/03/2026 11:30", "COLA 12PK", 1, 699),
    ("POS-2", "ST002", "03/03/2026 11:30", "COLA 12PK", 1, 699),
    ("POS-3", "ST003", "2026-03-11 09:00:00", None, 1, 600),
    ("POS-9", "ST001", "2026-03-10 09:00:00", P5, 1, 0),
]


def tables(spark) -> Tables:
    return Tables(
        transactions=spark.createDataFrame(SALES, schemas.TRANSACTIONS),
        products=spark.createDataFrame(PRODUCTS, schemas.PRODUCTS),
        stores=spark.createDataFrame(STORES, schemas.STORES),
        forecasts=spark.createDataFrame(FORECASTS, schemas.FORECASTS),
        raw_pos=spark.createDataFrame(RAW_POS, schemas.RAW_POS),
    )
