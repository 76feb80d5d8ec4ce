"""Readers of the two raw feeds.

No line is lost: `check_*` give every line, those that cannot be used with the
reason and the text; `read_*` and `parse_*` are the usable ones of them.

Every row carries `ingest_order`, its place in the feed, so that "the first
copy wins" means the same row however the files are split over tasks: the
record ids grow along one file block, and blocks sort by file and offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas

# Columns of a checked feed: why a line cannot be used, and the line.
REASON, LINE = "reason", "line"
BAD_RECORD = "bad_record"


def _file_order() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _with_bad_record(kind: T.DataType) -> T.StructType:
    return T.StructType([*kind.fields, T.StructField(BAD_RECORD, T.StringType())])


# Register rows as text: what is no number is told apart from what is missing.
_POS_TEXT = _with_bad_record(T.StructType(
    [T.StructField(f.name, T.StringType()) for f in schemas.RAW_POS]))
_ORDERS_CHECKED = _with_bad_record(schemas.RAW_ORDERS)
_POS_NUMBERS = [f for f in schemas.RAW_POS if f.dataType != T.StringType()]


def _made_once(checked: DataFrame) -> DataFrame:
    """The same rows. A filter on the reason is not moved below, where it would
    parse every line once for each condition."""
    return checked.select(F.inline(F.array(F.struct(*checked.columns))))


def _checked_pos(rows: DataFrame, line: Column, *keep: str) -> DataFrame:
    """Typed register rows of `rows`, which has them as text, with the `line` of
    those that cannot be used and the `reason`."""
    reason = F.when(F.col(BAD_RECORD).isNotNull(), F.lit("field count")).when(
        F.col("transaction_id").isNull(), F.lit("missing transaction_id"))
    for f in _POS_NUMBERS:
        reason = reason.when(F.col(f.name).isNull(), F.lit(f"missing {f.name}")).when(
            F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"bad {f.name}"))
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f in _POS_NUMBERS else f.name
             for f in schemas.RAW_POS]
    # Decided on the text: the typed columns have the same names.
    return _made_once(rows.withColumn(REASON, reason).select(
        *typed, *keep, REASON, F.when(F.col(REASON).isNotNull(), line).alias(LINE)))


def _checked_orders(rows: DataFrame, document: Column, *keep: str) -> DataFrame:
    """The same of nested orders."""
    incomplete = F.exists("items", lambda i: i.isNull() | i["sku"].isNull() | i["qty"].isNull()
                          | i["unit_price_cents"].isNull())
    reason = (
        F.when(F.col(BAD_RECORD).isNotNull(), F.when(
            F.try_parse_json(BAD_RECORD).isNull(), F.lit("malformed")).otherwise(F.lit("mistyped")))
        .when(F.col("order_id").isNull(), F.lit("missing order_id"))
        .when(F.col("items").isNull(), F.lit("missing items"))
        .when(incomplete, F.lit("incomplete item"))
    )
    return _made_once(rows.withColumn(REASON, reason).select(
        *schemas.RAW_ORDERS.names, *keep, REASON,
        F.when(F.col(REASON).isNotNull(), document).alias(LINE)))


def accepted(checked: DataFrame) -> DataFrame:
    """The usable rows of a checked feed."""
    return checked.where(F.col(REASON).isNull()).drop(REASON, LINE)


def rejected(checked: DataFrame) -> DataFrame:
    """The lines of a checked feed that cannot be used: where, why, and as they came."""
    return checked.where(F.col(REASON).isNotNull()).select("ingest_order", REASON, LINE)


def _pos_csv(reader, path: str | list[str]) -> DataFrame:
    # Without all columns the parser does not see how many fields a line has.
    return (
        reader.schema(_POS_TEXT).option("header", True).option("enforceSchema", False)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", BAD_RECORD).csv(path)
    )


def _pos_line() -> Column:
    """A line as it came, or one like it if its fields are sound."""
    return F.coalesce(BAD_RECORD, F.to_csv(F.struct(*schemas.RAW_POS.names)))


def _orders_json(reader, path: str | list[str]) -> DataFrame:
    return reader.schema(_ORDERS_CHECKED).option(
        "columnNameOfCorruptRecord", BAD_RECORD).json(path)


def _order_document() -> Column:
    return F.coalesce(BAD_RECORD, F.to_json(F.struct(*schemas.RAW_ORDERS.names)))


def check_pos_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines of CSV files with a header: typed, and with `reason` and `line`
    where they have too many or too few fields, lack a number or an id, or have
    something else in place of a number. A header of other names stops the job."""
    rows = _pos_csv(spark.read, path).select("*", _file_order().alias("ingest_order"))
    return _checked_pos(rows, _pos_line(), "ingest_order")


def read_pos_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The usable register rows of CSV files with a header."""
    return accepted(check_pos_csv(spark, path))


def check_orders_json(spark: SparkSession, path: str | list[str],
                      json_array: bool = False) -> DataFrame:
    """All orders, one JSON document per line (splittable), with `reason` and
    `line` where they are no JSON, have a value of another type, or lack what an
    order needs.

    `json_array=True` accepts files that hold one JSON array each; such a file
    cannot be split, so large feeds should arrive as JSON Lines.
    """
    rows = _orders_json(spark.read.option("multiLine", json_array), path)
    return _checked_orders(rows.select("*", _file_order().alias("ingest_order")),
                           _order_document(), "ingest_order")


def read_orders_json(spark: SparkSession, path: str | list[str],
                     json_array: bool = False) -> DataFrame:
    """The usable orders of JSON files."""
    return accepted(check_orders_json(spark, path, json_array))


def stream_pos_csv(spark: SparkSession, path: str, place: Column) -> DataFrame:
    """`check_pos_csv` of the files that turn up in a directory."""
    rows = _pos_csv(spark.readStream, path).select("*", place.alias("ingest_order"))
    return _checked_pos(rows, _pos_line(), "ingest_order")


def stream_orders_json(spark: SparkSession, path: str, place: Column) -> DataFrame:
    """`check_orders_json` of the files that turn up in a directory."""
    rows = _orders_json(spark.readStream, path).select("*", place.alias("ingest_order"))
    return _checked_orders(rows, _order_document(), "ingest_order")


def check_pos_lines(feed: DataFrame, line: str, order: str) -> DataFrame:
    """`check_pos_csv` of a feed of CSV lines without a header, such as messages
    of a queue; the column `order` is kept as their place in the feed."""
    fields = F.from_csv(line, _POS_TEXT.toDDL(), {"columnNameOfCorruptRecord": BAD_RECORD})
    rows = feed.select(fields.alias("row"), F.col(line).alias("as_it_came"),
                       F.col(order).alias("ingest_order")).select(
        "row.*", "as_it_came", "ingest_order")
    # An empty message has no fields, and nothing to be corrupt.
    return _checked_pos(rows, F.coalesce("as_it_came", F.lit("")), "ingest_order")


def parse_pos_lines(feed: DataFrame, line: str, order: str) -> DataFrame:
    return accepted(check_pos_lines(feed, line, order))


def check_order_documents(feed: DataFrame, document: str, order: str) -> DataFrame:
    """`check_orders_json` of a feed of JSON documents, as above."""
    row = F.from_json(document, _ORDERS_CHECKED, {"columnNameOfCorruptRecord": BAD_RECORD})
    rows = feed.select(row.alias("row"), F.col(document).alias("as_it_came"),
                       F.col(order).alias("ingest_order")).select(
        "row.*", "as_it_came", "ingest_order")
    return _checked_orders(rows, F.coalesce("as_it_came", F.lit("")), "ingest_order")


def parse_order_documents(feed: DataFrame, document: str, order: str) -> DataFrame:
    return accepted(check_order_documents(feed, document, order))


def flatten_customer(orders: DataFrame) -> DataFrame:
    """Staging shape of an order: customer fields on top, items kept whole."""
    return orders.select(
        "order_id",
        "placed_at",
        F.col("customer.id").alias("customer_id"),
        F.col("customer.loyalty_tier").alias("loyalty_tier"),
        "items",
        "fulfillment",
        "store_id",
        "ingest_order",
        *[c for c in (REASON, LINE) if c in orders.columns],
    )
