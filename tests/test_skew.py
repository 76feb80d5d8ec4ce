"""Queries on tables where one order, one product and one customer are hot."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
import skewed
from shelfline.operators import enrich
from shelfline.session import configure
from shelfline.sources import sample_views

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
NAMES = ["kpi_summary", "sales_by_channel", "top_products_growth", "forecast_vs_actual_product_id",
         "product_pairs", "product_quadrants", "raw_after", "dedup_keep_first", "fuzzy_matches",
         "clean_transactions", "run_summary", "reconciliation", "pk_violations", "fk_violations"]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return skewed.build(tmp_path_factory.mktemp("skewed"))


def test_the_order_is_hot(root):
    con = compare.oracle_connection(root)
    hot, total = con.execute("""SELECT max(n), sum(n) FROM
        (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""").fetchall()[0]
    assert hot > total * 0.3


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_on_skewed_tables(spark, root, name):
    df = QUERIES[name](spark, root)
    assert compare.spark_rows(df) == compare.oracle_rows(
        compare.oracle_connection(root), ORACLE[name])


def test_no_order_document_grows_with_its_order(spark, root):
    sizes = sample_views.raw_orders(spark, root).selectExpr("size(items) AS n").collect()
    assert max(r.n for r in sizes) < 2 * sample_views.ITEMS_PER_DOCUMENT


def test_a_hot_join_key_is_split(spark, root):
    """Without broadcasts, the hot product is joined by several tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    session = configure(spark.newSession())
    for key, value in settings.items():
        session.conf.set(key, value)
    lines = session.read.parquet(f"{root}/lineitem.parquet").repartition(6) \
        .withColumn("product_identifier", F.col("l_partkey").cast("string"))
    lookup = session.range(0, 2000).select(
        F.col("id").cast("string").alias("product_identifier"), F.lit("x").alias("product_id"))
    joined = enrich.join_products(lines, lookup)
    assert len(joined.collect()) == lines.count()
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().toString()
