"""Counting which items are bought together: the N most frequent pairs, exactly.

Before the pairs are made, it is found out how often the N-th best one occurs at
least. Any N pairs whose counts are known give such a bound; the pairs of the
most frequent items are counted for it. Items on fewer lines than that cannot be
in the result and go.

A pair in that many orders is also in an order that is not among the largest: the
largest orders make no pairs, but are looked up for the pairs that the others
made. Orders of every size take this one way. The items of an order are cut into
blocks and each pair of blocks is a group of its own, so no task ever holds a
huge order; most orders are a single block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most frequent items, whose pairs are counted for the bound.
FREQUENT_ITEMS = 128
# The most orders that make no pairs, and the items per block of an order.
LARGEST_ORDERS = 32
BLOCK_ITEMS = 256


def _pairs_of(members: DataFrame, *keys: str) -> DataFrame:
    """(keys, left, right) for each item of the sorted array `members` with
    every later one."""
    later = F.slice("members", F.col("place") + 2, F.size("members"))
    return (
        members.where(F.size("members") > 1)
        .select(*keys, "members", F.posexplode("members").alias("place", "left"))
        .select(*keys, "left", F.explode(later).alias("right"))
    )


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("orders"), F.min("order").alias("first_order"))


def _pairs_by_block(entries: DataFrame, block_items: int, largest: int) -> DataFrame:
    """(order, a, b), each once, of the items of the orders, of which the longest
    has `largest` lines. Every item goes to each pair of blocks that includes its
    own; no group is much larger than two blocks."""
    placed = entries.withColumn("blocks", F.lit(1))
    if largest > block_items:
        sizes = entries.groupBy("order").agg(F.count(F.lit(1)).alias("lines"))
        several = sizes.where(F.col("lines") > block_items).select(
            "order", F.ceil(F.col("lines") / block_items).cast("int").alias("several"))
        placed = entries.join(several, "order", "left").select(
            "order", "item", F.coalesce("several", F.lit(1)).alias("blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    cells = placed.select(
        "order", "item", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "order", "item", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    if largest > block_items:
        # Spread by cell: left as they are, all cells of an order would be grouped
        # where the order was joined.
        cells = cells.repartition("order", "low", "high")
    members = cells.groupBy("order", "low", "high").agg(
        F.sort_array(F.collect_set(F.struct("item", "block"))).alias("members"))
    # Two items of one block meet in several cells; only (block, block) counts.
    across = F.col("left.block") != F.col("right.block")
    return (
        _pairs_of(members, "order", "low", "high")
        .where((F.col("low") == F.col("high")) | across)
        .select("order", F.col("left.item").alias("a"), F.col("right.item").alias("b"))
    )


def _known_best(entries: DataFrame, support: DataFrame, n: int, frequent: int) -> list:
    """The n best of the pairs of the most frequent items, best first, with their
    exact counts."""
    pool = support.orderBy(F.desc("lines"), "item").limit(frequent).select("item")
    members = entries.join(pool, "item", "left_semi").groupBy("order").agg(
        F.sort_array(F.collect_set("item")).alias("members"))
    known = _counted(_pairs_of(members, "order").select(
        "order", F.col("left").alias("a"), F.col("right").alias("b")))
    return known.orderBy(F.desc("orders"), "first_order", "a", "b").limit(n).collect()


def top_pairs(lines: DataFrame, order: str, item: str, n: int,
              frequent: int = FREQUENT_ITEMS, largest: int = LARGEST_ORDERS,
              block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(a, b, orders, first_order): the n pairs of items found together in most
    orders. Equal counts rank by the lowest order that has the pair, then by
    the items.

    The bound (n rows) and the largest orders are found by two jobs when this is
    called; the rest is one lazy plan.
    """
    entries = lines.select(F.col(order).alias("order"), F.col(item).alias("item")) \
        .where(F.col("order").isNotNull() & F.col("item").isNotNull())
    # Lines of an item are at least as many as its orders.
    support = entries.groupBy("item").agg(F.count(F.lit(1)).alias("lines"))
    known = _known_best(entries, support, n, frequent)
    bound = known[-1].orders if len(known) == n else 0

    # Of the orders of several blocks, the largest are set aside, half as many as the
    # bound. If one order is enough for a pair, ties are won by the first orders,
    # which then stay. Without a bound all stay.
    by_size = entries.groupBy("order").agg(F.count(F.lit(1)).alias("lines")) \
        .orderBy(F.desc("lines"), "order").limit(largest + 1).collect()
    large = [r for r in by_size[:largest] if r.lines > block_items]
    if bound == 1:
        large = [r for r in large if r.order > known[-1].first_order]
    huge = [r.order for r in large[:-(-bound // 2)]]
    longest = max((r.lines for r in by_size if r.order not in huge), default=0)

    if bound > 1:
        entries = entries.join(support.where(F.col("lines") >= bound), "item", "left_semi")
    made = _counted(_pairs_by_block(
        entries.where(~F.col("order").isin(huge)) if huge else entries, block_items, longest))
    best_first = [F.desc("orders"), "first_order", "a", "b"]
    if not huge:
        return made.orderBy(*best_first).limit(n)
    # A pair in `bound` orders is in all but those set aside here.
    strong = made.where(F.col("orders") >= bound - len(huge))
    in_huge = entries.where(F.col("order").isin(huge)).distinct()
    looked_up = _counted(
        strong.select("a", "b")
        .join(in_huge.select("order", F.col("item").alias("a")), "a")
        .join(in_huge.select("order", F.col("item").alias("b")), ["order", "b"]))
    return (
        strong.unionByName(looked_up)
        .groupBy("a", "b")
        .agg(F.sum("orders").alias("orders"), F.min("first_order").alias("first_order"))
        .orderBy(*best_first).limit(n)
    )
