import dataclasses
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from shelfline.llm import common, hard_negatives, queries

SCHEMA = ("vec_id long, embedding array<double>, label int, rank int, row string, v int, "
          "norm double, score long")
ANCHORS = "vec_id % 5 = 0"
# Several blocks of anchors, buckets and files even for a few rows.
SMALL = hard_negatives.Mining(bucket=16, file_rows=40, block_bytes=8 * 4 * 10)


def table(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "r", 2, 0.5, 3) for r in rows], SCHEMA).repartition(3)


def brute(rows, how=hard_negatives.Mining()):
    kept = []
    for vec_id, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, label, [math.floor(how.scale * x) for x in v]))
    out = []
    last = lambda i: math.inf if i is None else i
    for a, (anchor, label, v) in enumerate(kept):
        if anchor is None or anchor % 5:
            continue
        scored = sorted(((sum(x * y for x, y in zip(v, w)), i, one == label)
                         for b, (i, one, w) in enumerate(kept) if b != a),
                        key=lambda t: (-t[0], last(t[1])))
        for best, positive, _ in [t for t in scored if t[2]][:how.positives]:
            band = [t for t in scored if not t[2]
                    and how.low * best <= 100 * t[0] <= how.high * best]
            out += [(anchor, positive, r, i, best, s)
                    for r, (s, i, _) in enumerate(band[:how.negatives], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == hard_negatives.RESULT
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    root = f"/root/testdata/{sf}"
    con = compare.oracle_connection(root)
    sql = queries.ORACLE_SQL["op11_hard_negatives"]
    df = queries.op11_hard_negatives(spark, root)
    assert compare.spark_types(df) == compare.oracle_types(con, sql)
    assert compare.spark_rows(df) == compare.oracle_rows(con, sql)


@pytest.mark.parametrize("how", [hard_negatives.Mining(), SMALL])
def test_clusters_lengths_and_ties(spark, how):
    common.prepare(spark)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 4))
    rows = []
    for i in range(150):
        v = centres[i % 6] + 0.1 * rng.standard_normal(4)
        rows.append((i, (v * rng.choice([0.2, 1.0, 3.0])).tolist(), int(rng.integers(3))))
    rows += [(200 + i, [1.0, 0.5, -0.25, 0.0], i % 2) for i in range(40)]  # copies
    rows += [(300, [0.0] * 4, 0), (305, [0.0] * 4, 1), (310, [-1.0] * 4, 2)]
    assert found(hard_negatives.mine(table(spark, rows), F.expr(ANCHORS), how)) == brute(rows)


def test_odd_rows(spark):
    common.prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (5, None, 1), (10, [1.0, None], 1),
            (15, [nan, 1.0], 1), (20, [inf, 1.0], 1), (25, [1.0, 1.0], None), (None, [1.0, 1.9], 1),
            (None, [0.9, 1.4], 2), (30, [], 1), (35, [1.0], 2), (40, [0.5, 0.5, 9.0], 2),
            (45, [0.0, 0.0], 2), (7, [0.8, 1.6], 2), (8, [0.8, 1.6], 2)]
    for how in (hard_negatives.Mining(), SMALL):
        assert found(hard_negatives.mine(table(spark, rows), F.expr(ANCHORS), how)) == brute(rows)
    nothing = table(spark, rows)
    assert found(hard_negatives.mine(nothing.where("false"), F.expr(ANCHORS))) == []
    assert found(hard_negatives.mine(nothing.where("vec_id = 7"), F.expr(ANCHORS))) == []
    assert found(hard_negatives.mine(nothing.where("label = 1"), F.expr(ANCHORS))) == []
    with pytest.raises(ValueError):
        hard_negatives.mine(table(spark, [(0, [1e9], 1), (1, [1e9], 1)]), F.expr(ANCHORS))


def test_ranges_only_drop_rows_that_cannot_reach():
    rng = np.random.default_rng(2)
    for _ in range(40):
        vectors = rng.integers(-60, 60, (50, 6)).astype(float)
        vectors[:5] = vectors[5]
        bucket = hard_negatives.Bucket(np.arange(50), np.arange(50), np.zeros(50), vectors)
        anchors = np.vstack((vectors[:8], np.zeros((1, 6))))
        scores = anchors @ vectors.T
        need = np.quantile(scores, rng.random(), axis=1)
        mask = bucket.candidates(anchors, need, 3)
        assert not ((scores >= need[:, None]) & ~mask).any()
        verified = bucket.scores(anchors, mask)
        assert (verified[mask] == scores[mask]).all()


def test_near_copies_leave_few_candidates():
    """With a high score needed, most of the bucket is never verified."""
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((2000, 32))
    vectors = np.rint(4096 * vectors / np.sqrt((vectors ** 2).sum(axis=1))[:, None])
    vectors[:20] = vectors[0]
    bucket = hard_negatives.Bucket(np.arange(2000), np.arange(2000), np.zeros(2000), vectors)
    need = np.array([(vectors[0] ** 2).sum()])
    mask = bucket.candidates(vectors[:1], need, 4)
    assert mask[0, :20].all() and mask.sum() < 100


def test_many_random_tables(spark):
    common.prepare(spark)
    random.seed(4)
    how = dataclasses.replace(SMALL, positives=2, negatives=2, low=30, high=100)
    rows = [(i, [random.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)], random.randrange(3))
            for i in range(120)]
    assert found(hard_negatives.mine(table(spark, rows), F.expr(ANCHORS), how)) == brute(rows, how)
