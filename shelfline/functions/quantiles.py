"""Exact medians of columns without gathering a column in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The sketch is off by at most 1/ACCURACY of the rows; the bracket around the
# middle is wider than that, so the middle values are always inside it.
_ACCURACY = 10_000
_BRACKET = [0.499, 0.501]
# Equal stretches that a bracket is cut into.
PARTS = 1024


def exact_medians(df: DataFrame, columns: list[str]) -> Column:
    """Medians of the columns as one scalar struct column with their names; the
    mean of the middle two for even counts, nulls aside.

    A sketch brackets the middle, values below the bracket are only counted, and
    the distinct values inside it (0.2 % of the ranks) are counted by stretches.
    Only values of the stretches that the middle falls into are sorted, so no
    task has all values of the bracket.
    """
    numbers = {c: F.col(c).cast("double") for c in columns}
    ends = df.agg(F.struct(*[
        F.percentile_approx(value, _BRACKET, _ACCURACY).alias(c)
        for c, value in numbers.items()])).scalar()

    def of_column(pick) -> Column:
        return F.coalesce(*[F.when(F.col("name") == c, pick(c)) for c in columns])

    # Scalars are put in a column before their parts are used: every mention of
    # a scalar is planned on its own.
    counts = (
        df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("name"), value.alias("v")) for c, value in numbers.items()])))
        .where(F.col("v").isNotNull())
        .groupBy("name", "v").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("ends", ends)
        .select("name", "v", "rows",
                of_column(lambda c: F.get(F.col("ends").getField(c), F.lit(0))).alias("low"),
                of_column(lambda c: F.get(F.col("ends").getField(c), F.lit(1))).alias("high"))
    )

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

    sizes = counts.agg(F.struct(*[
        F.struct(rows_where(F.col("name") == c).alias("total"),
                 rows_where((F.col("name") == c) & (F.col("v") < F.col("low"))).alias("below"))
        .alias(c) for c in columns])).scalar()

    width = F.col("high") - F.col("low")
    stretch = F.when(width > 0, F.least(
        F.floor((F.col("v") - F.col("low")) / width * PARTS), F.lit(PARTS - 1))).otherwise(0)
    bracket = counts.where(F.col("v").between(F.col("low"), F.col("high"))) \
        .select("name", "v", "rows", stretch.alias("part"))
    # At most PARTS rows a column.
    earlier = Window.partitionBy("name").orderBy("part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        bracket.groupBy("name", "part").agg(F.sum("rows").alias("n"))
        .withColumn("sizes", sizes)
        .select("name", "part", "n", of_column(lambda c: F.col("sizes").getField(c)).alias("size"))
        .select("name", "part", "n", F.col("size.total").alias("total"),
                (F.col("size.below") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
                .alias("before"))
    )
    lower, upper = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = parts.where((F.col("before") < upper) & (F.col("before") + F.col("n") >= lower))
    so_far = Window.partitionBy("name", "part").orderBy("v") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bracket.join(middle, ["name", "part"]).withColumn(
        "rank", F.col("before") + F.sum("rows").over(so_far))

    def at_rank(c: str, rank: Column) -> Column:
        return F.min(F.when((F.col("name") == c) & (F.col("rank") >= rank), F.col("v")))

    return ranked.agg(F.struct(*[
        ((at_rank(c, lower) + at_rank(c, upper)) / 2).alias(c) for c in columns])).scalar()
