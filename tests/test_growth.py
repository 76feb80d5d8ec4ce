"""Settings and plans that keep a task's memory and broadcasts from growing with the tables."""

import pytest

import __spark_entry__ as entry
from shelfline import session
from shelfline.operators import resolver
from shelfline.sources import sample_views as views

ROOT = "/root/testdata/sf0.001"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def own(spark):
    """A session whose settings no other test sees."""
    return session.configure(spark.newSession())


@pytest.mark.parametrize("name", ["freshness", "kpi_summary", "staged_pos"])
def test_shuffles_start_with_partitions_for_the_input(own, monkeypatch, name):
    monkeypatch.setattr(views, "input_bytes", lambda spark, root: 1 << 30)
    entry.queries()[name](own, ROOT)
    assert own.conf.get(INITIAL) == "256"
    assert own.conf.get(MERGED) == f"{16 << 20}b"


def test_smaller_settings_of_the_deployment_stay(own):
    own.conf.set(MERGED, "8m")
    own.conf.set("spark.sql.shuffle.partitions", "300")
    session.size_tables(own, 1 << 30)
    assert (own.conf.get(MERGED), own.conf.get(INITIAL)) == (f"{8 << 20}b", "300")


def test_input_is_measured_by_its_files(own):
    assert 100_000 < views.input_bytes(own, ROOT) < 1_000_000


def test_tables_are_taken_for_larger_than_their_files(own):
    """Names of 7 KB in a file make some 100 KB of rows: too much to broadcast here."""
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
    tables = entry.queries()["resolver_cascade"](own, ROOT)
    assert "BroadcastHashJoin" not in _plan(tables)


def test_lists_of_trigrams_are_not_broadcast(own):
    strings = own.createDataFrame([("LRG RNG 7",), ("BL BOLT 12",)], "identifier string")
    found = resolver.fuzzy_matches(strings, views.products(own, ROOT))
    plan = _plan(found)
    by_list = [x for x in plan.split("\n") if "Join" in x and "name_gram#" in x]
    assert len(by_list) == 2 and all("SortMergeJoin" in x for x in by_list)


@pytest.mark.parametrize("name", ["merged_load", "load_months"])
def test_two_loads_read_the_feed_once(own, name):
    loads = entry.queries()[name](own, ROOT)
    plan = loads._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" in loads._jdf.queryExecution().withCachedData().toString()
    assert "Relation [l_orderkey" not in plan
    own.catalog.clearCache()


@pytest.mark.parametrize("name", ["run_summary", "reconciliation", "resolved_products",
                                  "clean_transactions", "enriched"])
def test_queries_with_the_resolver_number_the_lines_once(own, name):
    own.catalog.clearCache()
    plan = entry.queries()[name](own, ROOT)._jdf.queryExecution()
    assert "InMemoryRelation" in plan.withCachedData().toString()
    assert "- Relation [l_orderkey" not in plan.optimizedPlan().toString()
    own.catalog.clearCache()
