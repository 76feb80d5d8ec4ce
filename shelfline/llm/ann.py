"""Nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are lifted by one dimension, which turns the largest inner product into
the smallest distance, and rotated at random. Lists are scanned in column
blocks: after each block of dimensions a hypothesis test on the partial distance
gives up the vectors that are almost surely farther than the nearest found.
Vectors that pass all blocks are scored exactly, in double precision, on the
original components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import common

# Vectors of a list, and queries, that meet in one place.
LIST_BLOCK, QUERY_BLOCK = 2048, 512


@dataclass(frozen=True)
class Search:
    """Production parameters. `sample` bounds the vectors that the lists are
    fitted on and, with `per_list` of them for a list, the number of lists.
    `probes` is the share of the lists that a query looks at; embeddings without
    clusters need many. `pilot` vectors of the sample are a list that every
    query probes; with the `first` nearest lists they give it the bound that its
    other scans start from."""
    neighbours: int = 20
    probes: float = 0.65
    sample: int = 16_384
    pilot: int = 256
    first: int = 4
    per_list: int = 64
    columns: int = 16
    error: float = 2.1
    rounds: int = 8
    seed: int = 7


@dataclass
class Lists:
    rotation: np.ndarray
    centres: np.ndarray
    limit: float  # the greatest squared norm
    pilot_ids: np.ndarray
    pilot: np.ndarray  # as given

    def lift(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors with the extra dimension, which a query has as 0."""
        rest = np.zeros(len(vectors)) if query else np.sqrt(
            np.maximum(0, self.limit - (vectors * vectors).sum(axis=1)))
        return np.column_stack((vectors, rest)) @ self.rotation


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)


def fit(vectors: DataFrame, search: Search) -> Lists | None:
    """Rotation and list centres (k-means) from at most `sample` vectors, drawn
    by a hash of the id; None without vectors."""
    # The smallest hashes of all; each task sends no more than `sample` rows.
    first = vectors.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.size("v"))).first()
    if not first[0]:
        return None
    rows = vectors.orderBy(F.xxhash64("vec_id", "v")).limit(search.sample).select("vec_id", "v").collect()
    points = np.array([r.v for r in rows])
    rng = np.random.default_rng(search.seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((points.shape[1] + 1,) * 2))
    pilot = max(search.pilot, search.neighbours + 1)
    lists = Lists(rotation, np.zeros((0, 0)), float(first[1]),
                  np.array([r.vec_id for r in rows[:pilot]]), points[:pilot])
    points = lists.lift(points, query=False)
    distinct = np.unique(points, axis=0)
    count = max(1, min(len(distinct), len(points) // search.per_list))
    centres = distinct[rng.choice(len(distinct), count, replace=False)]
    for _ in range(search.rounds):
        near = _distances(points, centres).argmin(axis=1)
        sizes = np.bincount(near, minlength=count)
        sums = np.stack([np.bincount(near, points[:, d], count)
                         for d in range(points.shape[1])], axis=1)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], centres)
    lists.centres = centres
    return lists


def clean(vectors: DataFrame, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, v, norm) of the vectors that take part: no null, no null or
    non-finite component, not zero."""
    v = F.col(vector_col).cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(
        F.forall("v", lambda x: x.isNotNull())).where(
        F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))).withColumn(
        "norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).where("norm > 0")


def _one_each(rows: DataFrame) -> DataFrame:
    """One row an id: of several vectors the first in order of their components."""
    return rows.groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("first")).select(
        "vec_id", "first.*")


def _of_one_length(*tables: DataFrame) -> list[DataFrame]:
    """Vectors that are shorter than the longest end in zeros."""
    sizes = [t.agg(F.min(F.size("v")), F.max(F.size("v"))).first() for t in tables]
    longest = max((s[1] for s in sizes if s[1] is not None), default=0)
    if all(s[0] in (None, longest) for s in sizes):
        return list(tables)
    return [t.withColumn("v", F.concat("v", F.array_repeat(
        F.lit(0.0), F.lit(longest) - F.size("v")))) for t in tables]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(shared, probes: float, query: bool):
    """Each vector's nearest list, or the lists that a query probes, nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            far = _distances(lists.lift(_matrix(batch.column(1)), query), lists.centres)
            n = max(1, int(np.ceil(probes * far.shape[1])))
            near = far.argsort(axis=1, kind="stable")[:, :n]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(near.tolist(), pa.list_(pa.int32()))],
                names=["vec_id", "v", "lists"])
    return run


def scan(points: np.ndarray, queries: np.ndarray, bound: np.ndarray, columns: int,
         error: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) that no test has given up. `bound` is a distance
    within which each query has enough vectors. Column blocks are worked off
    for all pairs while many live, and then for the living ones alone."""
    width = points.shape[1]
    part, rows, places = np.zeros((len(queries), len(points))), None, None
    for low in range(0, width, columns):
        high = min(low + columns, width)
        # Of a vector at distance r the first d of D rotated dimensions have about
        # d / D of r squared; the rest of the factor is the test's acceptance region.
        factor = 1.0 if high == width else (1 + error / np.sqrt(high)) ** 2 * high / width
        limit = bound * factor * (1 + 1e-9) + 1e-9
        if rows is None:
            part += _distances(queries[:, low:high], points[:, low:high])
            keep = part <= limit[:, None]
            part[~keep] = np.inf
            if 4 * keep.sum() < keep.size or high == width:
                rows, places = np.nonzero(keep)
                part = part[rows, places]
        else:
            gap = queries[rows, low:high] - points[places, low:high]
            part = part + (gap * gap).sum(axis=1)
            keep = part <= limit[rows]
            rows, places, part = rows[keep], places[keep], part[keep]
    return rows, places


def _search_groups(shared, search: Search):
    """Of each block of a list and of queries: each query's nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in batches:
            queries, ids, scores = [], [], []
            for group, asked in zip(batch.column("members"), batch.column("queries"), strict=True):
                members = group.values.field("vec_id").to_numpy()
                vectors = _matrix(group.values.field("v"))
                names = asked.values.field("vec_id").to_numpy()
                wanted = _matrix(asked.values.field("v"))
                lifted = lists.lift(wanted, query=True)
                k = search.neighbours
                bound = asked.values.field("bound").to_numpy()
                row, place = scan(lists.lift(vectors, query=False), lifted, bound,
                                  search.columns, search.error)
                other = members[place] != names[row]
                row, place = row[other], place[other]
                exact = (vectors[place] * wanted[row]).sum(axis=1)
                # The distance test again, on the exact product.
                least = (lists.limit + (wanted * wanted).sum(axis=1) - bound) / 2
                near = exact >= least[row] - 1e-9
                row, place, exact = row[near], place[near], exact[near]
                order = np.lexsort((members[place], -exact, row))
                row, place, exact = row[order], place[order], exact[order]
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                best = nth < k
                queries += names[row[best]].tolist()
                ids += members[place[best]].tolist()
                scores += exact[best].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(scores, pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def _search_pilot(shared, neighbours: int):
    """Each query's nearest of the pilot vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in batches:
            queries, ids, scores = [], [], []
            for name, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                exact = (lists.pilot * v.values.to_numpy()).sum(axis=1)
                best = np.lexsort((lists.pilot_ids, -exact))
                best = best[lists.pilot_ids[best] != name][:neighbours]
                queries += [name] * len(best)
                ids += lists.pilot_ids[best].tolist()
                scores += exact[best].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(scores, pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, search: Search = Search(),
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): of each row of `queries` the rows of
    `vectors` other than its own with the largest inner product that were found,
    nearest first, ties to the smaller vec_id; all others, if they are fewer than
    asked for.

    Every vector is in one list; a query probes the share `probes` of them. Lists and
    queries meet in blocks of bounded size, so neither a list with very many
    (equal) vectors nor one that very many queries probe is one task's work.
    Vectors that are null or zero or have null or non-finite components, and
    rows with a null id, take no part. Rows of one id are one vector, the first in
    order of its components; a vector shorter than others ends in zeros; an empty
    table gives an empty result; other columns are not read.
    """
    spark = common.prepare(vectors.sparkSession)
    empty = "query_id long, rank int, vec_id long, score double"
    points = common.stash(_one_each(clean(vectors, id_col, vector_col)))
    asked = common.stash(_one_each(clean(queries, id_col, vector_col)))
    points, asked = _of_one_length(points, asked)
    lists = fit(points, search)
    if lists is None:
        return spark.createDataFrame([], empty)
    shared = spark.sparkContext.broadcast(lists)
    kind = "vec_id long, v array<double>, lists array<int>"
    placed = common.stash(points.select("vec_id", "v").mapInArrow(
        _assign(shared, 0, query=False), kind).select(
        "vec_id", "v", F.col("lists")[0].alias("list")))
    probing = common.stash(asked.select("vec_id", "v").mapInArrow(
        _assign(shared, search.probes, query=True), kind).select(
        "vec_id", "v", F.posexplode("lists").alias("place", "list")))

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        """Rows with a block of their list, dealt by a hash of the id."""
        counts = F.broadcast(rows.groupBy("list").agg(
            F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"{name}s")))
        return rows.join(counts, "list").withColumn(
            name, F.pmod(F.xxhash64("vec_id"), F.col(f"{name}s")).cast("int"))

    def cut(rows: DataFrame, size: int, name: str, other: DataFrame, other_size: int,
            other_name: str) -> DataFrame:
        """Blocks of rows, each once for every block of the other side."""
        counts = F.broadcast(other.groupBy("list").agg(
            F.ceil(F.count(F.lit(1)) / other_size).cast("int").alias("copies")))
        return blocks(rows, size, name).join(counts, "list").withColumn(
            other_name, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    pairs = "query_id long, vec_id long, score double"
    keys = ["list", "block", "asked"]

    def searched(wanted: DataFrame) -> DataFrame:
        """The best vectors within its bound for each query and probed list block."""
        members = cut(placed, LIST_BLOCK, "block", wanted, QUERY_BLOCK, "asked").groupBy(
            *keys).agg(F.collect_list(F.struct("vec_id", "v")).alias("members"))
        asking = cut(wanted, QUERY_BLOCK, "asked", placed, LIST_BLOCK, "block").groupBy(
            *keys).agg(F.collect_list(F.struct("vec_id", "v", "bound")).alias("queries"))
        return members.join(asking, keys).select("members", "queries").mapInArrow(
            _search_groups(shared, search), pairs)

    def bounded(found: DataFrame) -> DataFrame:
        """Each query with the distance of the last of its nearest so far; without
        a bound, if it has not found enough. With the score s it is the greatest
        squared norm and the query's own, less 2 s."""
        last = found.withColumn("nth", F.row_number().over(by_score)).where(
            F.col("nth") == search.neighbours).select(
            F.col("query_id").alias("of"), F.col("score").alias("last"))
        norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
        return probing.join(last, F.col("vec_id") == F.col("of"), "left").select(
            "vec_id", "v", "list", "place", F.coalesce(
                lists.limit + norm - 2 * F.col("last"), F.lit(float("inf"))).alias("bound"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pilot = asked.select("vec_id", "v").mapInArrow(_search_pilot(shared, search.neighbours), pairs)
    first = common.stash(pilot.union(searched(
        bounded(pilot).where(F.col("place") < search.first))).groupBy(
        "query_id", "vec_id").agg(F.max("score").alias("score")))
    found = first.union(searched(bounded(first).where(F.col("place") >= search.first))).groupBy(
        "query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(by_score)).where(
        F.col("rank") <= search.neighbours).select("query_id", "rank", "vec_id", "score")
