"""Money as whole cents inside a plan, dollars as double at the report edge.

A sum of BIGINT cents is exact, does not depend on the order in which partial
sums meet, and stays in generated code; wide decimal sums do not.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(price: Column) -> Column:
    """Whole cents of a two-decimal price."""
    return F.rint(price.cast("double") * 100).cast("bigint")


def dollars(amount_cents: Column) -> Column:
    return amount_cents.cast("double") / 100


def to_price(amount_cents: Column) -> Column:
    """Decimal dollars of a cents column, as stored in the clean table. Exact,
    and a decimal product is much cheaper than a quotient."""
    return (amount_cents.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")


def rounded(value: Column, places: int) -> Column:
    """Round by way of a decimal, so that another SQL engine rounding the same
    cast gets the same digits."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, places: int) -> Column:
    """part / whole as a rounded percentage; null where `whole` is zero."""
    return rounded(ratio(part, whole) * 100, places)


# Measures over the columns of `transactions`, in cents.

def line_revenue() -> Column:
    return cents(F.col("sale_price")) * F.col("quantity")


def line_cost() -> Column:
    return cents(F.col("unit_price")) * F.col("quantity")


def unit_margin() -> Column:
    return cents(F.col("sale_price")) - cents(F.col("unit_price"))


def revenue_sum() -> Column:
    return F.coalesce(F.sum(line_revenue()), F.lit(0))


def cost_sum() -> Column:
    return F.coalesce(F.sum(line_cost()), F.lit(0))


def units_sum() -> Column:
    return F.coalesce(F.sum(F.col("quantity").cast("bigint")), F.lit(0))


def mean_unit_margin() -> Column:
    """Plain mean over lines of the margin of one unit, in dollars."""
    return rounded(F.sum(unit_margin()).cast("double") / F.count(F.lit(1)) / 100, 2)
