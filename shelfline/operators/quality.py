"""Data-quality checks. Each returns the offending rows or keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.money import dollars, line_revenue


def null_violations(df: DataFrame, required: list[str] | None = None,
                    key: str = "transaction_id") -> DataFrame:
    """(key, column_name) for every null in a required column."""
    columns = required or schemas.TRANSACTIONS_REQUIRED
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]),
        lambda name: name.isNotNull())
    return df.select(F.col(key), F.explode(missing).alias("column_name"))


def pk_violations(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """(key, copies) for every key value that is not unique."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def domain_violations(df: DataFrame, column: str = "channel",
                      allowed: tuple[str, ...] = schemas.CHANNELS) -> DataFrame:
    """Rows with a value outside the allowed set; null is no violation."""
    return df.where(~F.col(column).isin(*allowed))


def fk_violations(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of `child` whose key is not in `parent`; null refers to nothing."""
    parents = parent.select(key).distinct()
    return child.where(F.col(key).isNotNull()).join(parents, key, "left_anti")


def pk_report(tables: dict[str, DataFrame],
              keys: dict[str, str] | None = None) -> DataFrame:
    """(table_name, key, violations): how many key values of each given table
    are not unique."""
    return _stacked([
        pk_violations(tables[name], key)
        .agg(F.lit(name).alias("table_name"), F.lit(key).alias("key"),
             F.count(F.lit(1)).alias("violations"))
        for name, key in (keys or schemas.PRIMARY_KEYS).items() if name in tables])


def fk_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, key, violations): how many rows of each given table refer to
    a row that is not there."""
    return _stacked([
        fk_violations(tables[child], tables[parent], key)
        .agg(F.lit(child).alias("table_name"), F.lit(key).alias("key"),
             F.count(F.lit(1)).alias("violations"))
        for child, parent, key in schemas.FOREIGN_KEYS
        if child in tables and parent in tables])


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def bad_timestamps(parsed_lines: DataFrame) -> DataFrame:
    """Lines whose time could not be read."""
    return parsed_lines.where(F.col("sale_timestamp").isNull())


def reconcile(metrics: DataFrame) -> DataFrame:
    """(check_name, left_value, right_value, difference) over run counters.

    Rows read must equal rows kept plus rows dropped, at every step.
    """
    value = {name: F.coalesce(F.sum(F.when(F.col("metric") == name, F.col("value"))), F.lit(0))
             for name in ("raw_pos_rows", "exploded_lines", "duplicates_removed",
                          "lines_after_dedup", "unknown_rows_dropped",
                          "bad_time_rows_dropped", "final_rows")}
    checks = {
        "lines_in": (value["raw_pos_rows"] + value["exploded_lines"],
                     value["lines_after_dedup"] + value["duplicates_removed"]),
        "lines_out": (value["lines_after_dedup"],
                      value["final_rows"] + value["unknown_rows_dropped"]
                      + value["bad_time_rows_dropped"]),
    }
    sides = metrics.agg(*[
        F.struct(F.lit(name).alias("check_name"), left.alias("left_value"),
                 right.alias("right_value"), (left - right).alias("difference"))
        .alias(name)
        for name, (left, right) in checks.items()])
    return sides.select(F.inline(F.array(*checks)))


def reconcile_rollups(lines: DataFrame, dimensions: list[str]) -> DataFrame:
    """(check_name, left_value, right_value, difference): the revenue that the
    report of each dimension shows against that of all lines. A report leaves out
    lines without the dimension, and then does not add up.

    All reports and the total come from one pass over the lines.
    """
    parts = lines.groupingSets([[d] for d in dimensions] + [[]], *dimensions).agg(
        F.sum(line_revenue()).alias("cents"), F.grouping_id().alias("id"))
    # The last dimension has the lowest bit of the id, set where it is not grouped by.
    all_bits = (1 << len(dimensions)) - 1
    ids = {d: all_bits ^ (1 << i) for i, d in enumerate(reversed(dimensions))}

    def revenue(rows) -> Column:
        return F.coalesce(F.sum(F.when(rows, F.col("cents"))), F.lit(0))

    whole = revenue(F.col("id") == all_bits)
    sides = parts.agg(*[
        F.struct(F.lit(d).alias("check_name"), dollars(shown).alias("left_value"),
                 dollars(whole).alias("right_value"), dollars(shown - whole).alias("difference"))
        .alias(f"check_{d}")
        for d in dimensions
        for shown in [revenue((F.col("id") == ids[d]) & F.col(d).isNotNull())]])
    return sides.select(F.inline(F.array(*sides.columns)))
