"""Mixing sources to target weights, with DataFrame functions alone.

Words are added up per source. The sources' weights share out all words, and a
source's target stops at `cap` times its words; what is over is shared again by
weight among the rest, until no target is above its cap. A source's target over
its words is the repetition rate of its documents: each is emitted as often as
the whole part of the rate says, and once more with the fraction as
probability, by a coin seeded with a hash of the document.

A null text has no words; a null source is a source of its own, the last.
Documents of a source without words are not emitted. The coin depends on
doc_id and text alone, so runs agree, and repeated rows fare alike. An empty
table gives no rows. Input columns are kept apart in `row`, so none can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import common

WORD = r"[^\x20\x09-\x0D]+"
# Sources' names and numbers up to this size are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
_WIDE = "decimal(38,0)"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def coin(seed: int) -> Column:
    """A number from 0 up to 1 for a document: 52 bits of a hash."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    return F.conv(F.substring(F.sha2(name, 256), 1, 13), 16, 10).cast("long") / F.lit(2.0 ** 52)


def source_sizes(docs: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Stored rows (source, source_size, weight), the weights dealt out in the
    order of the sources by code point, null last, again from the first.

    Sources are numbered within range partitions, and partitions by their
    counts, so no task sees them all."""
    sizes = common.stash(docs.groupBy("source").agg(
        F.sum(words(F.col("text"))).alias("source_size")))
    order = [F.col("source").asc_nulls_last()]
    placed = common.stash(sizes.repartitionByRange(*order).withColumn(
        "part", F.spark_partition_id()))
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row a partition.
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    numbered = placed.withColumn(
        "place", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    weight = F.get(F.array([F.lit(int(w)).cast("long") for w in weights]),
                   ((F.col("place") + F.col("before")) % len(weights)).cast("int"))
    return common.stash(numbered.join(F.broadcast(before), "part").select(
        "source", "source_size", weight.alias("weight")))


def targets(sizes: DataFrame, cap: int = 3) -> DataFrame:
    """Adds `target`. A round finds the sources whose share is above their cap,
    exactly in whole numbers, and shares the rest again; a few numbers come to
    the driver each round, and there are as many rounds as the excess moves on."""
    whole = int(sizes.agg(F.sum(F.col("source_size").cast(_WIDE))).first()[0] or 0)
    size, weight = F.col("source_size").cast(_WIDE), F.col("weight").cast(_WIDE)
    left, weights, capped = whole, None, 0
    over = F.lit(False)
    while True:
        row = sizes.withColumn("over", over).agg(
            F.count_if("over").alias("n"),
            F.sum(F.when(F.col("over"), size)).alias("capped"),
            F.sum(F.when(~F.col("over"), weight)).alias("weights")).first()
        if weights is not None and row.n == capped:
            break
        left, weights, capped = whole - cap * int(row.capped or 0), int(row.weights or 0), row.n
        if not weights:
            break
        # Capped sources stay capped: what is left for a weight only grows.
        over = weight * F.lit(left).cast(_WIDE) > size * cap * F.lit(weights).cast(_WIDE)
    share = (weight * F.lit(left).cast(_WIDE)).cast("double") / F.lit(float(weights or 1))
    return sizes.withColumn(
        "target", F.when(over, F.col("source_size") * F.lit(float(cap))).otherwise(share))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 13,
        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows (row, size, source_size, target, copies), one for each document."""
    if not weights or min(weights) <= 0 or cap < 1:
        raise ValueError("weights must be positive and the cap at least 1")
    shares = targets(source_sizes(docs, weights), cap).select(
        F.col("source").alias("of"), "source_size", "target")
    taking = shares.agg(F.count(F.lit(1)), F.sum(F.octet_length("of"))).first()
    if 24 * taking[0] + (taking[1] or 0) <= broadcast_bytes:
        shares = F.broadcast(shares)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("source").alias("by"),
                       words(F.col("text")).alias("size"), coin(seed).alias("coin"))
    rate = F.when(F.col("source_size") > 0, F.least(
        F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    copies = F.floor("rate") + (F.col("coin") < F.col("rate") - F.floor("rate")).cast("long")
    return rows.join(shares, F.col("by").eqNullSafe(F.col("of"))).withColumn("rate", rate).select(
        "row", "size", "source_size", "target", copies.alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as given."""
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
                        .alias("one")).select("row.*")
