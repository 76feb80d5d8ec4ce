"""Date windows and time buckets."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRANULARITIES = ("day", "week", "month")


def as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def in_window(df: DataFrame, start: str | date, end: str | date,
              column: str = "sale_date") -> DataFrame:
    """Rows dated start..end, both ends included.

    A table laid out by month also gets the matching month bounds, so that
    whole directories are pruned before any file is opened.
    """
    first, last = as_date(start), as_date(end)
    kept = df.where(F.col(column).between(F.lit(first), F.lit(last)))
    if column == "sale_date" and "sale_month" in df.columns:
        kept = kept.where(F.col("sale_month").between(
            F.lit(first.replace(day=1)), F.lit(last.replace(day=1))))
    return kept


def previous_window(start: str | date, end: str | date) -> tuple[date, date]:
    """The window of equal length that ends the day before `start`."""
    first, last = as_date(start), as_date(end)
    days = (last - first).days + 1
    return first - timedelta(days=days), first - timedelta(days=1)


def bucket_date(day: Column, granularity: str) -> Column:
    """First day of the bucket; weeks begin on Monday."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"unknown granularity {granularity!r}, use one of {GRANULARITIES}")
    return day if granularity == "day" else F.trunc(day, granularity)
