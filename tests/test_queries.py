"""Every registered query against its SQL, and the plans they run by."""

import functools
import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import compare

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# The numbered operators and the pipeline have tests of their own.
OWN_TESTS = re.compile(r"op\d+_|pipeline$")
QUERIES, ORACLE = ({k: v for k, v in found.items() if not OWN_TESTS.match(k)}
                   for found in (entry.queries(), entry.oracle_sql()))


@functools.cache
def connection():
    return compare.oracle_connection(ROOT)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, ROOT)
    columns, rows = compare.spark_rows(df)
    expected_columns, expected = compare.oracle_rows(connection(), ORACLE[name])
    assert columns == expected_columns
    assert compare.spark_types(df) == compare.oracle_types(connection(), ORACLE[name])
    assert len(rows) > 0
    assert rows == expected


def _plan(spark, name):
    return QUERIES[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_product_and_no_python(spark, name):
    plan = _plan(spark, name)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", ["category_breakdown", "product_pairs", "sales_by_region"])
def test_date_window_reaches_the_scan(spark, name):
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in _plan(spark, name)


def test_result_does_not_depend_on_partition_count(spark):
    names = ["product_margins", "product_pairs", "kpi_summary", "fuzzy_matches"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in ("3", "31"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append([compare.spark_rows(QUERIES[n](spark, ROOT)) for n in names])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_entry(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("hidden", ["public_tokenizers", "corpus_pipeline", "shelfline.llm"])
def test_the_other_queries_do_without_the_optional_operators(hidden):
    """Whatever keeps the training-data operators from being imported."""
    code = (f"import sys; sys.modules[{hidden!r}] = None\n"
            "import __spark_entry__ as e; print('NAMES', *e.queries()); e.oracle_sql()")
    found = subprocess.run([sys.executable, "-c", code], cwd=entry_folder(), text=True,
                           capture_output=True, check=True).stdout
    assert set(found.split("NAMES")[1].split()) == set(QUERIES)


def entry_folder() -> str:
    return os.path.dirname(os.path.abspath(entry.__file__))
