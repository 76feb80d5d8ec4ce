"""The sale lines as a table that takes further loads.

A load writes the months it touches anew, under its own run number, and then a
snapshot: which run holds each month's lines. The snapshot of the highest
number is the table. Nothing of an earlier run is overwritten, so a load that
fails leaves the table as it was, and readers of the old table go on.

    lines/run=3/sale_month=2026-04-01/outcome=loaded/...
    snapshots/run=3/...
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.cleaning import COPY_KEY, key_hashes

LINES, SNAPSHOTS = "lines", "snapshots"
# How Spark names the directory of a null, such as the month of an unreadable time.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
SNAPSHOT = "sale_month date, held_by int"


def merge_lines(stored: DataFrame, fresh: DataFrame, key: list[str] = COPY_KEY) -> DataFrame:
    """Lines of both, each key once: a stored line stays as it is, and a fresh
    one with its key only adds to its `copies`. Both have a key once each.

    Only hashes and counts are grouped; the keys that both have are joined back
    by a hash table, so no line is sorted."""
    both = stored.withColumn("is_fresh", F.lit(False)).unionByName(
        fresh.withColumn("is_fresh", F.lit(True))).withColumns(key_hashes(key))
    in_both = (
        both.groupBy("key_high", "key_low")
        .agg(F.sum("copies").alias("all_copies"), F.count(F.lit(1)).alias("found"))
        .where("found > 1")
    )
    return (
        both.join(in_both.hint("shuffle_hash"), ["key_high", "key_low"], "left")
        .where(F.col("found").isNull() | ~F.col("is_fresh"))
        .withColumn("copies", F.coalesce("all_copies", "copies"))
        .select(*stored.columns)
    )


def _directories(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in no order; none if nothing does."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(f.getPath().toString()) for f in files.globStatus(path) or []]


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    """The run numbers in the paths that match."""
    return sorted(int(p.rsplit("run=", 1)[1].split("/")[0])
                  for p in _directories(spark, pattern))


def runs(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished loads; the last one is the table."""
    return _numbers(spark, f"{root}/{SNAPSHOTS}/run=*/_SUCCESS")


def next_run(spark: SparkSession, root: str) -> int:
    """A number that no load has used, finished or not."""
    used = [n for name in (SNAPSHOTS, LINES) for n in _numbers(spark, f"{root}/{name}/run=*")]
    return max(used, default=0) + 1


def snapshot(spark: SparkSession, root: str, run: int | None = None) -> dict:
    """The run that holds each month's lines, after a load; of the last one by
    default, and empty before the first."""
    done = runs(spark, root)
    if run is None and not done:
        return {}
    if run is not None and run not in done:
        raise ValueError(f"no finished load {run} in {root}")
    rows = spark.read.schema(SNAPSHOT).parquet(f"{root}/{SNAPSHOTS}/run={run or done[-1]}")
    # One row a month.
    return {r.sale_month: r.held_by for r in rows.collect()}


def _read_months(spark: SparkSession, root: str, held: dict) -> DataFrame | None:
    if not held:
        return None
    paths = [f"{root}/{LINES}/run={n}/sale_month={month or NO_MONTH}" for month, n in held.items()]
    rows = spark.read.option("basePath", f"{root}/{LINES}").parquet(*sorted(paths))
    return rows.withColumn("sale_month", F.col("sale_month").cast("date"))


def read_lines(spark: SparkSession, root: str, run: int | None = None) -> DataFrame:
    """All lines after a load, the last by default. A filter on `sale_month` or
    `outcome` reads their directories alone."""
    rows = _read_months(spark, root, snapshot(spark, root, run))
    if rows is None:
        raise ValueError(f"nothing was loaded into {root}")
    return rows.drop("run")


def _months(lines: DataFrame) -> set:
    return {r.sale_month for r in lines.select("sale_month").distinct().collect()}


def _write_snapshot(spark: SparkSession, root: str, run: int, held: dict) -> None:
    """From here on the load is the table. Fails if another load took the number."""
    spark.createDataFrame(list(held.items()), SNAPSHOT).coalesce(1) \
        .write.mode("errorifexists").parquet(f"{root}/{SNAPSHOTS}/run={run}")


def add_lines(fresh: DataFrame, root: str, run: int, everywhere: bool = False,
              key: list[str] = COPY_KEY) -> list:
    """Add stored lines with `copies`, `outcome` and `sale_month`, each key once;
    returns the months that were written.

    Copies are looked for among the lines of the months that `fresh` has.
    `everywhere=True` also finds copies under another month, by the keys of the
    whole table, and writes these months too.
    """
    spark = fresh.sparkSession
    held = snapshot(spark, root)
    touched = _months(fresh)
    if everywhere and held:
        known = _read_months(spark, root, held).select("sale_month", *key_hashes(key).values())
        known = known.toDF("sale_month", "key_high", "key_low")
        asked = fresh.select(*[c.alias(n) for n, c in key_hashes(key).items()])
        touched |= _months(known.join(asked, ["key_high", "key_low"], "left_semi"))
    stored = _read_months(spark, root, {m: n for m, n in held.items() if m in touched})
    lines = fresh if stored is None else merge_lines(stored.select(*fresh.columns), fresh, key)
    (
        lines.hint("rebalance", "sale_month", "outcome")
        .sortWithinPartitions("sale_month", "outcome", "sale_date", "category", "store_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("sale_month", "outcome").parquet(f"{root}/{LINES}/run={run}")
    )
    _write_snapshot(spark, root, run, held | dict.fromkeys(touched, run))
    return sorted(touched, key=str)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what only loads before the last `keep` need, and returns the
    directories. Readers of those loads lose their files."""
    if keep < 1:
        raise ValueError("at least one load must be kept")
    done = runs(spark, root)
    wanted = {(n, m) for run in done[-keep:] for m, n in snapshot(spark, root, run).items()}
    names = {f"run={n}/sale_month={m or NO_MONTH}" for n, m in wanted}
    old = [p for p in _directories(spark, f"{root}/{LINES}/run=*/sale_month=*")
           if "/".join(p.split("/")[-2:]) not in names]
    old += [p for p in _directories(spark, f"{root}/{SNAPSHOTS}/run=*")
            if int(p.rsplit("=", 1)[1]) in done[:-keep]]
    for p in old:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return sorted(old)
