"""The numbers of lines in their orders, and what is moved to give them."""

import os

import pytest

import __spark_entry__ as entry
import skewed
from shelfline.sources import sample_views as views


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return skewed.build(tmp_path_factory.mktemp("numbered"))


def test_long_orders_are_numbered_as_others(spark, root, monkeypatch):
    """One order has a third of all lines; by stretches it gets the same numbers."""
    columns = ["transaction_id", "product_id", "quantity", "sale_price", "sale_timestamp"]
    whole = sorted(map(tuple, views.transactions(spark, root).select(columns).collect()))
    monkeypatch.setattr(views, "LONG_ORDER", 3)
    stretched = views.transactions(spark, root).select(columns)
    assert sorted(map(tuple, stretched.collect())) == whole
    assert len({row[0] for row in whole}) == len(whole) > 5000


@pytest.mark.parametrize("name", ["normalized_union", "staged_orders", "null_violations"])
def test_little_is_moved_for_each_line(spark, name):
    """Bytes shuffled a line of lineitem, of which the tables in files have about 18."""
    root = "/root/testdata/sf0.01"
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = disk.getAllFiles().mkString("\n").split("\n")
        return {n: os.path.getsize(n) for n in names
                if "shuffle_" in n and n.endswith(".data") and os.path.exists(n)}
    lines = spark.read.parquet(f"{root}/lineitem.parquet").count()
    before = shuffled()
    entry.queries()[name](spark, root).write.format("noop").mode("overwrite").save()
    moved = sum(size for n, size in shuffled().items() if n not in before)
    assert 10 * lines < moved < 150 * lines
