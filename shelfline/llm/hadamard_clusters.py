"""Centroid clustering by a progressive search in the Walsh-Hadamard domain.

Vectors become integers and are transformed once, exactly, by additions and
subtractions; their coefficients are kept in the order of sign changes, coarse
first. The transform multiplies every squared distance by the width, so the sum
over any first coefficients is a lower bound of it. An assignment adds up
coefficient differences block by block, finishes the leading centroid of a
vector, and drops the centroids whose sum so far is already strictly greater;
what stays is finished over all coefficients. Sums of a cluster are added up
within tasks, in the same domain, and transformed back.

Vectors that are null, of another width or with a null or non-finite component
take no part; a null id does (its vector never is a first centroid while
others are left). Repeated rows count as often as they are there. With fewer
vectors than clusters there are as many clusters as vectors; without any, the
result has no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import common

# Scaled components up to this keep all sums of a task and all distances in 64 bits.
LARGEST = 1 << 24


@dataclass(frozen=True)
class Clustering:
    """`width` is a power of two; `steps` are the ends of the coefficient blocks."""
    clusters: int = 8
    rounds: int = 10
    seed: int = 3
    width: int = 64
    scale: int = 1024
    steps: tuple[int, ...] = (4, 8, 16, 32, 64)


def _butterflies(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in Hadamard order."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack((a + b, a - b), axis=2)
        half *= 2
    return rows.reshape(n, width)


def sequency(width: int) -> np.ndarray:
    """Hadamard places by the number of sign changes of their function."""
    table = _butterflies(np.eye(width, dtype=np.int64))
    return np.argsort((table[:, 1:] != table[:, :-1]).sum(axis=1), kind="stable")


def transform(rows: np.ndarray) -> np.ndarray:
    """Coefficients of integer rows, coarse to fine."""
    return _butterflies(rows)[:, sequency(rows.shape[1])]


def restore(coefficients: np.ndarray) -> np.ndarray:
    """The rows that `transform` made these coefficients of."""
    width = coefficients.shape[1]
    plain = np.empty_like(coefficients)
    plain[:, sequency(width)] = coefficients
    return _butterflies(plain) // width


def nearest(points: np.ndarray, centres: np.ndarray,
            steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Of coefficient rows: the nearest centre (ties: the smaller number), and
    the squared distance in the coefficient domain."""
    n, k = len(points), len(centres)
    sums = np.zeros((n, k), np.int64)
    alive = np.ones((n, k), bool)
    finished = np.zeros((n, k), bool)
    best = np.full(n, np.iinfo(np.int64).max)
    low = 0
    for high in steps:
        row, centre = np.nonzero(alive)
        sums[row, centre] += ((points[row, low:high] - centres[centre, low:high]) ** 2).sum(axis=1)
        low = high
        leader = np.where(alive, sums, np.iinfo(np.int64).max).argmin(axis=1)
        new = np.flatnonzero(~finished[np.arange(n), leader])
        lead = leader[new]
        rest = ((points[new, high:] - centres[lead, high:]) ** 2).sum(axis=1)
        best[new] = np.minimum(best[new], sums[new, lead] + rest)
        finished[new, lead] = True
        alive &= sums <= best[:, None]
    left = np.where(alive, sums, np.iinfo(np.int64).max)
    cluster = left.argmin(axis=1)
    return cluster, left[np.arange(n), cluster]


def keep(vectors: DataFrame, how: Clustering, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, v) of the vectors that take part, v as integers."""
    v = F.col(vector_col).cast("array<double>")
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        (F.size("v") == how.width) & F.forall("v", lambda x: x.isNotNull())).where(
        F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return kept.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(how.scale)))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.array(list(rows), pa.list_(pa.int64()))


def _coefficients(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _lists(transform(_matrix(batch.column(1), width)))],
                    names=["vec_id", "w"])
    return run


def _cluster_sums(centres: np.ndarray, steps: tuple[int, ...]):
    """A task's count and coefficient sums of each cluster it has vectors of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centres), np.int64), np.zeros_like(centres)
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column(0), centres.shape[1])
                cluster, _ = nearest(points, centres, steps)
                counts += np.bincount(cluster, minlength=len(centres))
                np.add.at(sums, cluster, points)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(counts[there]), _lists(sums[there])],
            names=["cluster", "n", "total"])
    return run


def _assigned(centres: np.ndarray, steps: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = centres.shape[1]
        for batch in batches:
            if batch.num_rows:
                cluster, far = nearest(_matrix(batch.column(1), width), centres, steps)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster, pa.int32()), pa.array(far // width)],
                    names=["vec_id", "cluster", "distance"])
    return run


def _moved(stored: DataFrame, centres: np.ndarray, how: Clustering) -> np.ndarray:
    """The centres after one round, as integer vectors' coefficients."""
    parts = stored.select("w").mapInArrow(
        _cluster_sums(centres, how.steps), "cluster int, n long, total array<long>")
    # A row for each cluster and coefficient: as many for any table.
    rows = parts.select("cluster", "n", F.posexplode("total").alias("place", "x")).groupBy(
        "cluster", "place").agg(F.sum("n").alias("n"),
                                F.sum(F.col("x").cast("decimal(20,0)")).alias("total")).collect()
    totals = np.zeros(centres.shape, object)
    counts = np.ones(len(centres), object)
    for r in rows:
        totals[r.cluster, r.place] = int(r.total)
        counts[r.cluster] = r.n
    there = sorted({r.cluster for r in rows})
    means = restore(totals[there]) // counts[there][:, None]
    centres = centres.copy()
    centres[there] = transform(means.astype(np.int64))
    return centres


def cluster(vectors: DataFrame, how: Clustering = Clustering(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, cluster, distance), one for each vector that takes part, and
    the final centres as integer vectors, which are `clusters` rows at most.

    Raises ValueError for components that do not fit exact 64-bit sums.
    """
    kept = keep(vectors, how, id_col, vector_col)
    name = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")), 256)
    first = [r.v for r in kept.orderBy(name.asc_nulls_last(), "v").limit(how.clusters).collect()]
    most = kept.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    if most is not None and most > LARGEST:
        raise ValueError(f"a scaled component of {most} is beyond {LARGEST}")
    stored = common.stash(kept.mapInArrow(_coefficients(how.width), "vec_id long, w array<long>"))
    if not first:
        return stored.selectExpr("vec_id", "0 as cluster", "0L as distance"), np.zeros(
            (0, how.width), np.int64)
    centres = transform(np.array(first, np.int64))
    for _ in range(how.rounds):
        centres = _moved(stored, centres, how)
    found = stored.mapInArrow(_assigned(centres, how.steps),
                              "vec_id long, cluster int, distance long")
    return common.stash(found), restore(centres)


def with_inertia(found: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds the distance summed over a row's cluster and over all, and the
    centre as text (decimal components joined by commas)."""
    spark = found.sparkSession
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    total = sum(sums.values())
    rows = [(c, sums.get(c, 0), total, ",".join(map(str, centre.tolist())))
            for c, centre in enumerate(centres)]
    about = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centre string")
    # One row a cluster.
    return found.join(F.broadcast(about), "cluster")
