from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import compare
from shelfline.llm import common, queries, source_mix

EXTRA = ("row string, size int, rate int, coin string, of string, by string, target string, "
         "copies int, part int, place int, weight int, over int")


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2, "c", "o", "b", "t", 3, 4, 5, 6, 7) for r in rows],
                                 f"doc_id long, text string, source string, {EXTRA}").repartition(3)


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - cap * sum(sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: Fraction(weight[s] * rest, sum(weight[x] for x in open_)) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return {s: float(share[s]) if s in share else float(cap * sizes[s]) for s in order}
        capped |= over


def test_targets(spark):
    common.prepare(spark)
    lengths = {"a": 1, "b": 500, "c": 3, "é": 40, "": 7, None: 2, "Z": 0, "z" * 50: 90, "😀": 5,
               "ｚ": 1000, "d": 2}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(lengths.items())]
    got = source_mix.mix(table(spark, rows)).select(
        "row.source", "source_size", "target").collect()
    assert {r.source: r.target for r in got} == pytest.approx(brute_targets(lengths), rel=1e-12)
    assert {r.source: r.source_size for r in got} == lengths


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    root = f"/root/testdata/{sf}"
    con = compare.oracle_connection(root)
    sql = queries.ORACLE_SQL["op13_source_mix"]
    df = queries.op13_source_mix(spark, root)
    assert compare.spark_types(df) == compare.oracle_types(con, sql)
    assert compare.spark_rows(df) == compare.oracle_rows(con, sql)


def test_plan_has_no_python(spark):
    plan = queries.op13_source_mix(
        spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_emitted_copies(spark):
    common.prepare(spark)
    rows = [(i, "w " * (1 + i % 7), "abc"[min(2, i % 9)]) for i in range(4000)]
    docs = table(spark, rows)
    mixed = source_mix.mix(docs)
    emitted = source_mix.emit(mixed)
    assert emitted.columns == docs.columns
    times = Counter(r.doc_id for r in emitted.collect())
    taken = Counter()
    for r in mixed.collect():
        rate = r.target / r.source_size
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 3
        assert r.copies == times[r.row.doc_id]
        taken[r.row.source, r.target] += r["size"] * r.copies
    for (_, target), words in taken.items():
        assert words == pytest.approx(target, rel=0.1)
    # The same over other partitions and by the shuffled join; another seed differs.
    again = {r.row.doc_id: r.copies for r in source_mix.mix(
        docs.repartition(7), broadcast_bytes=0).collect()}
    assert {i: n for i, n in again.items() if n} == times
    other = {r.row.doc_id: r.copies for r in source_mix.mix(docs, seed=14).collect()}
    assert other != again


def test_odd_rows(spark, odd_documents, no_documents):
    common.prepare(spark)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "x", None), (4, "x", None),
            (None, "x y", "b"), (None, None, None), (5, "é" * 9 + "\x1c\xa0 q", ""),
            (6, "w " * 100_000, "b")]
    got = source_mix.mix(table(spark, rows)).collect()
    want = sorted((str(i), len((t or "").replace("\x1c", "_").replace("\xa0", "_").split()))
                  for i, t, _ in rows)
    assert sorted((str(r.row.doc_id), r["size"]) for r in got) == want
    assert all(r.copies == 0 for r in got if r.source_size == 0)
    same = [r.copies for r in got if r.row.doc_id == 4]
    assert len(same) == 2 and len(set(same)) == 1
    assert source_mix.mix(odd_documents).count() == odd_documents.count()
    assert source_mix.mix(no_documents).collect() == []
    empty = table(spark, [(1, None, "a"), (2, " ", "b")])
    assert [(r.target, r.copies) for r in source_mix.mix(empty).collect()] == [(0.0, 0)] * 2
    for bad in ((), (1, 0)):
        with pytest.raises(ValueError):
            source_mix.mix(empty, weights=bad)


def test_many_sources_are_numbered_in_order(spark):
    common.prepare(spark)
    rows = [(i, "a b c", f"s{i:04}") for i in range(1000)]
    sizes = source_mix.source_sizes(table(spark, rows), (5, 2, 1))
    assert [r.weight for r in sizes.orderBy("source").collect()] == [
        (5, 2, 1)[i % 3] for i in range(1000)]
    assert sizes.where(F.col("source_size") != 3).count() == 0
