"""Deterministic cleaning of the raw feeds into one table of sale lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas

# A clock time with its offset, as nearly all come: "2026-03-15T14:22:10Z", "...+05:30".
_ISO_PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
# Any time with an offset.
_ISO_WITH_OFFSET = r"T.*([Zz]|[+-]\d{2}(:?\d{2})?)$"
# Other shapes of ISO 8601 times, each with the extended form it is brought to:
# small z, basic date, basic time, no seconds.
_ISO_SHAPES = [
    (r"z$", "Z"),
    (r"^(\d{4})(\d{2})(\d{2})T", "$1-$2-$3T"),
    (r"T(\d{2})(\d{2})(?=\d{2}|Z|[+-]|$)", "T$1:$2:"),
    (r":(?=Z|[+-]|$)", ""),
    (r"(T\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00"),
]

# The columns a duplicate shares with the row it repeats.
COPY_KEY = ["transaction_id", "product_identifier", "store_id"]


# Places in a feed stay below this, so the second feed's come after all of the first's.
_FEED = 1 << 62


def _feed_order(feed: DataFrame, number: int) -> Column:
    """Where a row stands in both feeds: one number if its place in its own is one."""
    place = F.col("ingest_order")
    if isinstance(feed.schema["ingest_order"].dataType, T.IntegralType):
        return place.cast("bigint") + F.lit(number * _FEED).cast("bigint")
    return F.struct(F.lit(number).alias("feed"), place.alias("position"))


def explode_orders(orders: DataFrame) -> DataFrame:
    """One row per order item; an order without items yields none. A long order
    may come in several documents, each with the index of its `first_item`."""
    first = F.col("first_item") if "first_item" in orders.columns else F.lit(0)
    items = orders.select("*", F.posexplode("items").alias("place", "item")).withColumn(
        "item_index", F.col("place") + first)
    return items.select(
        F.concat(F.lit("ECOM-"), "order_id", F.lit("-"),
                 F.col("item_index").cast("string")).alias("transaction_id"),
        "order_id",
        F.col("item.sku").alias("product_identifier"),
        F.col("item.qty").alias("quantity"),
        F.col("item.unit_price_cents").alias("sale_price_cents"),
        F.col("placed_at").alias("sale_timestamp_raw"),
        "store_id",
        "customer_id",
        F.lit("ecommerce").alias("channel"),
        _feed_order(orders, 1).alias("ingest_order"),
    )


def normalize_pos(raw_pos: DataFrame) -> DataFrame:
    """Register rows in the columns of `explode_orders`; a register row is its
    own order and has no customer."""
    return raw_pos.select(
        "transaction_id",
        F.col("transaction_id").alias("order_id"),
        F.col("upc_or_name").alias("product_identifier"),
        "quantity",
        F.col("price_charged_cents").alias("sale_price_cents"),
        F.col("timestamp_raw").alias("sale_timestamp_raw"),
        "store_id",
        F.lit(None).cast("string").alias("customer_id"),
        F.lit("pos").alias("channel"),
        _feed_order(raw_pos, 0).alias("ingest_order"),
    )


def union_channels(pos_lines: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Both feeds on one schema, register rows before order items."""
    return pos_lines.unionByName(order_lines)


def parse_time(raw: Column) -> Column:
    """UTC timestamp of a raw time, null if it has none of the known shapes.

    Each value is tried against the one format its shape allows: ISO 8601 with
    an offset if it has a "T", month/day/year if it has a slash, else
    year-month-day. Padded and unpadded numbers are both accepted. Only ISO times
    of another shape than the usual one are rewritten before they are read.
    """
    iso = raw
    for shape, extended in _ISO_SHAPES:
        iso = F.regexp_replace(iso, shape, extended)
    return (
        F.when(raw.rlike(_ISO_PLAIN), F.try_to_timestamp(raw))
        .when(raw.contains("T"), F.when(raw.rlike(_ISO_WITH_OFFSET), F.try_to_timestamp(iso)))
        .when(raw.contains("/"), F.try_to_timestamp(raw, F.lit("M/d/yyyy H:m")))
        .otherwise(F.try_to_timestamp(raw, F.lit("yyyy-M-d H:m:s")))
    )


def parse_timestamps(lines: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """Add `sale_timestamp` and its UTC `sale_date`.

    `on_error="fail"` stops the job at the first unreadable time, as a strict
    load would; "quarantine" leaves it null for `quality.bad_timestamps`.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    parsed = parse_time(F.col("sale_timestamp_raw"))
    if on_error == "fail":
        parsed = F.when(parsed.isNotNull(), parsed).otherwise(
            F.raise_error(F.concat(
                F.lit("unreadable time: "),
                F.coalesce("sale_timestamp_raw", F.lit("null")))).cast("timestamp"))
    return (
        lines.withColumn("sale_timestamp", parsed)
        .withColumn("sale_date", F.to_date("sale_timestamp"))
    )


def key_hashes(key: list[str]) -> dict[str, Column]:
    """128 bits that stand for a key; a null differs from every value."""
    parts = [part for c in key for part in (F.col(c).isNull(), F.col(c))]
    return {"key_high": F.xxhash64(*parts), "key_low": F.xxhash64(F.lit("low"), *parts)}


def keep_first_copy(lines: DataFrame, key: list[str] = COPY_KEY) -> DataFrame:
    """One row per key, the earliest in feed order, with the number of `copies`.

    Null keys compare equal; `ingest_order` may not repeat within a key. The
    first copies are looked for with hashes of the key and the place alone, as
    an aggregate that shrinks a group of copies inside each task. Only keys that
    do repeat are joined back to the rows, by a hash table of those keys, so no
    row is sorted and a hot key can be split.
    """
    hashed = lines.withColumns(key_hashes(key))
    repeated = (
        hashed.groupBy("key_high", "key_low")
        .agg(F.min("ingest_order").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    return (
        hashed.join(repeated.hint("shuffle_hash"), ["key_high", "key_low"], "left")
        .where(F.col("first").isNull() | (F.col("first") == F.col("ingest_order")))
        .select(*lines.columns, F.coalesce("copies", F.lit(1)).alias("copies"))
    )


def store_is_missing() -> Column:
    return (F.col("channel") == "ecommerce") & F.col("store_id").isNull()


def route_missing_stores(lines: DataFrame,
                         store: str = schemas.FULFILLMENT_STORE) -> DataFrame:
    """Order lines without a store ship from the fulfillment center; register
    rows are left as they are."""
    return lines.withColumn(
        "store_id", F.when(store_is_missing(), F.lit(store)).otherwise(F.col("store_id")))


def unmatched_identifiers(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct product identifiers that are no catalog id."""
    seen = lines.select(F.col("product_identifier").alias("identifier")).distinct()
    known = products.select(F.col("product_id").alias("identifier"))
    return seen.where(F.col("identifier").isNotNull()).join(known, "identifier", "left_anti")


def distinct_lines(raw_pos: DataFrame, orders: DataFrame,
                   on_error: str = "quarantine") -> DataFrame:
    """Lines of both feeds, times read, copies dropped."""
    lines = union_channels(normalize_pos(raw_pos), explode_orders(orders))
    return keep_first_copy(parse_timestamps(lines, on_error))


def clean_lines(raw_pos: DataFrame, orders: DataFrame,
                on_error: str = "quarantine") -> DataFrame:
    """All deterministic steps: explode, union, parse, drop copies, route."""
    return route_missing_stores(distinct_lines(raw_pos, orders, on_error))
