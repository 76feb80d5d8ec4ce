import hashlib
import math

import numpy as np
import pytest

import compare
from shelfline.llm import common, hadamard_clusters, queries

SCHEMA = ("vec_id long, embedding array<float>, cluster string, distance string, w int, "
          "centre string, label int")


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "d", 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def brute(rows, clusters=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda v: min((far(v, c), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        of = [pick(v)[1] for _, v in kept]
        centres = [[sum(x) // len(x) for x in zip(*own)] if own else centre
                   for k, centre in enumerate(centres)
                   for own in [[v for (_, v), o in zip(kept, of) if o == k]]]
    out = [(i, *pick(v)[::-1]) for i, v in kept]
    total = sum(d for *_, d in out)
    return sorted(((i, k, d, sum(x[2] for x in out if x[1] == k), total,
                    ",".join(map(str, centres[k]))) for i, k, d in out), key=str)


def found(df):
    got, centres = hadamard_clusters.cluster(df)
    rows = hadamard_clusters.with_inertia(got, centres).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centre").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    root = f"/root/testdata/{sf}"
    con = compare.oracle_connection(root)
    sql = queries.ORACLE_SQL["op12_hadamard_clusters"]
    df = queries.op12_hadamard_clusters(spark, root)
    assert compare.spark_types(df) == compare.oracle_types(con, sql)
    assert compare.spark_rows(df) == compare.oracle_rows(con, sql)


def test_odd_rows(spark):
    common.prepare(spark)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(30)]
    rows += [(100 + i % 4, [0.25] * 64) for i in range(20)]  # copies, ids repeated
    rows += [(None, [0.5] * 64), (None, rng.standard_normal(64).tolist()), (1, None), (2, []),
             (3, [1.0] * 63), (4, [1.0] * 65), (5, [None] + [1.0] * 63),
             (6, [float("nan")] * 64), (7, [float("inf")] * 64), (8, [0.0] * 64)]
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, rows[:3])) == brute(rows[:3])
    assert found(table(spark, rows[30:50])) == brute(rows[30:50])
    assert found(table(spark, rows).where("false")) == []
    with pytest.raises(ValueError):
        found(table(spark, [(1, [1e6] * 64)]))


def test_transform_is_exact():
    rng = np.random.default_rng(3)
    rows = rng.integers(-9000, 9000, (40, 64))
    coefficients = hadamard_clusters.transform(rows)
    assert (hadamard_clusters.restore(coefficients) == rows).all()
    assert ((coefficients ** 2).sum(axis=1) == 64 * (rows ** 2).sum(axis=1)).all()
    table_ = hadamard_clusters.transform(np.eye(64, dtype=np.int64)).T
    assert [(np.diff(f) != 0).sum() for f in table_] == [*range(64)]


def test_progressive_search_is_exact_with_ties():
    rng = np.random.default_rng(8)
    steps = hadamard_clusters.Clustering().steps
    for spread in (1, 3, 500):
        points = hadamard_clusters.transform(rng.integers(-spread, spread + 1, (300, 64)))
        centres = np.vstack((points[:5], points[:2], points[7]))
        far = ((points[:, None] - centres) ** 2).sum(axis=2)
        cluster, distance = hadamard_clusters.nearest(points, centres, steps)
        assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
