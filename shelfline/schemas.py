"""Explicit schemas of every table. Column names and types are fixed values:
they are the data model users bring with them."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_MONEY = T.DecimalType(10, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Product codes stay strings everywhere: their leading zeros matter.
RAW_POS = _struct(
    transaction_id=_S, store_id=_S, timestamp_raw=_S, upc_or_name=_S,
    quantity=_I, price_charged_cents=_I,
)

ORDER_ITEM = _struct(sku=_S, qty=_I, unit_price_cents=_I, promo_code=_S)

RAW_ORDERS = _struct(
    order_id=_S,
    placed_at=_S,
    customer=_struct(id=_S, loyalty_tier=_S),
    items=T.ArrayType(ORDER_ITEM),
    fulfillment=_S,
    store_id=_S,
)

SUPPLIERS = _struct(supplier_id=_I, supplier_name=_S, contact_email=_S, region=_S)

STORES = _struct(
    store_id=_S, store_name=_S, city=_S, state=_S, region=_S, store_type=_S,
)

PRODUCTS = _struct(
    product_id=_S, product_name=_S, category=_S, unit_price_cents=_I, supplier_id=_I,
)

FORECASTS = _struct(
    forecast_id=_L, product_id=_S, store_id=_S, week_start=T.DateType(),
    forecasted_units=_I, forecasted_revenue=_MONEY,
)

ALIASES = _struct(identifier=_S, product_id=_S)
# As stored: of an identifier the highest version counts; no product retires it.
ALIAS_HISTORY = _struct(identifier=_S, product_id=_S, version=_L)

TRANSACTIONS = _struct(
    transaction_id=_S, order_id=_S, product_id=_S, product_name=_S, category=_S,
    sale_date=T.DateType(), sale_timestamp=T.TimestampType(), quantity=_I,
    unit_price=_MONEY, sale_price=_MONEY, store_id=_S, region=_S,
    customer_id=_S, channel=_S, inserted_at=T.TimestampType(),
)

TRANSACTION_COLUMNS = [f.name for f in TRANSACTIONS if f.name != "inserted_at"]

# Columns of `transactions` that may not be null.
TRANSACTIONS_REQUIRED = [
    "transaction_id", "order_id", "product_id", "product_name", "category",
    "sale_date", "sale_timestamp", "quantity", "unit_price", "sale_price",
    "store_id", "channel",
]

CHANNELS = ("pos", "ecommerce")
FULFILLMENT_STORE = "FC-EAST"

PRIMARY_KEYS = {
    "transactions": "transaction_id",
    "products": "product_id",
    "stores": "store_id",
    "suppliers": "supplier_id",
    "forecasts": "forecast_id",
}

# (child table, parent table, key)
FOREIGN_KEYS = [
    ("transactions", "products", "product_id"),
    ("transactions", "stores", "store_id"),
    ("products", "suppliers", "supplier_id"),
    ("forecasts", "products", "product_id"),
    ("forecasts", "stores", "store_id"),
]
