"""Hard negatives by exact inner-product search with coordinate pruning.

Rows are ordered by length and cut into buckets. In a bucket, every coordinate
of the unit vectors has a sorted list. A bucket's greatest length turns the
score that an anchor still needs into a least cosine, and the least cosine into
a range that the largest (focus) coordinates of a matching unit vector must lie
in. The ranges are looked up in the sorted lists, their rows intersected, and
only rows in all ranges are verified by the exact integer score. Buckets come
longest first and each raises the score needed, so a bucket that cannot reach
it is passed over whole. Ranges are only ever too wide, so the result is exact.

An anchor's positives are its best rows of the same label; its hard negatives,
for each positive, the best rows of other labels with a score in a band below
the positive's. Higher scores come first, ties by smaller id.

Anchors are worked off in blocks of a fixed number of bytes, which are the only
thing broadcast; every task goes through its buckets and keeps a few rows of
each anchor, so no row is paired in a shuffle.

Rows with a null label, a null vector, or a null or non-finite component take no
part. Vectors of unequal length are compared as if the shorter ended in zeros;
zero vectors score 0. A null id is no anchor and comes last among ties. Repeated
rows are rows of their own: each is a positive of the others, and an anchor that
is there twice has its result twice. Without anchors, positives or negatives
there are no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import common

# Below any score; an id after all others stands for null.
NONE = -(1 << 62)
LAST_ID = np.iinfo(np.int64).max
# Anchors whose scores with a bucket are in memory at a time.
CHUNK = 256
FOUND = "anchor int, slot int, id long, score long"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
EMPTY = ", ".join(f"{c} {'int' if c == 'rank' else 'long'}" for c in RESULT)


@dataclass(frozen=True)
class Mining:
    """`low` and `high` bound a negative's score in percent of the positive's."""
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    focus: int = 4
    bucket: int = 4096
    file_rows: int = 65_536
    block_bytes: int = 8 << 20


@dataclass
class Block:
    """Anchors, and the slots of each that rows are looked for: a slot takes
    the `keep` best rows with low <= score <= high, none worse than its floor."""
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    same_label: bool
    keep: int
    low: np.ndarray  # anchors x slots
    high: np.ndarray
    floor_score: np.ndarray
    floor_id: np.ndarray


class Bucket:
    """Rows of similar length, with the sorted list of each coordinate."""

    def __init__(self, rows, ids, labels, vectors):
        self.rows, self.ids, self.labels, self.vectors = rows, ids, labels, vectors
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        self.length = lengths.max()
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = unit.argsort(axis=0, kind="stable")
        self.lists = np.ascontiguousarray(np.take_along_axis(unit, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)

    def candidates(self, anchors: np.ndarray, need: np.ndarray, focus: int) -> np.ndarray:
        """For each anchor, the rows in the feasible range of all its focus
        coordinates; every row that reaches the score needed is among them."""
        n, (many, width) = len(self.ids), anchors.shape
        lengths = np.sqrt((anchors * anchors).sum(axis=1))
        reach = lengths * self.length
        # The least cosine, a little lower than exact.
        least = np.where(reach > 0, need / np.where(reach > 0, reach, 1), np.sign(need) * 2)
        least -= 1e-9 + 1e-9 * np.abs(least)
        found = np.zeros((many, n), np.uint8)
        found[least <= 0] = 1
        some = np.flatnonzero((least > 0) & (least <= 1))
        if not len(some):
            return found.view(bool)
        unit = anchors[some] / lengths[some][:, None]
        places = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :min(focus, width)]
        own = np.arccos(np.clip(np.take_along_axis(unit, places, axis=1), -1, 1))
        spread = np.arccos(least[some])[:, None]
        low = np.cos(np.minimum(np.pi, own + spread)) - 1e-9
        high = np.cos(np.maximum(0, own - spread)) + 1e-9
        first, last = np.zeros(places.shape, int), np.zeros(places.shape, int)
        for place in np.unique(places):
            here = places == place
            first[here] = self.lists[place].searchsorted(low[here], "left")
            last[here] = self.lists[place].searchsorted(high[here], "right")
        for i, a in enumerate(some):
            narrow = np.flatnonzero(last[i] - first[i] < n)
            for p in narrow:
                found[a, self.order[places[i, p], first[i, p]:last[i, p]]] += 1
            found[a] = found[a] == len(narrow)
        return found.view(bool)

    def scores(self, anchors: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Exact scores of the candidates. Where a fourth of the bucket or more
        are candidates, the product over all rows costs less than gathering them."""
        out = np.zeros(found.shape)
        many = found.sum(axis=1)
        dense = many * 4 >= found.shape[1]
        out[dense] = anchors[dense] @ self.vectors.T
        for a in np.flatnonzero(~dense & (many > 0)):
            here = np.flatnonzero(found[a])
            out[a, here] = self.vectors[here] @ anchors[a]
        return out


class Best:
    """The best rows of every slot so far."""

    def __init__(self, block: Block):
        shape = (*block.low.shape, block.keep)
        self.block = block
        self.score = np.full(shape, NONE)
        self.id = np.full(shape, LAST_ID)

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Score and id that a row must at least equal to enter a slot."""
        score, id_ = self.score[..., -1], self.id[..., -1]
        floor = self.block.floor_score
        higher = (score > floor) | (score == floor) & (id_ < self.block.floor_id)
        return np.where(higher, score, floor), np.where(higher, id_, self.block.floor_id)

    def look(self, bucket: Bucket, focus: int) -> None:
        block = self.block
        for start in range(0, len(block.ids), CHUNK):
            part = slice(start, start + CHUNK)
            bound, bound_id = (x[part] for x in self.bounds())
            low, high = np.maximum(block.low[part], bound), block.high[part]
            wanted = low <= high
            need = np.where(wanted, low, LAST_ID).min(axis=1)
            anchors = block.vectors[part]
            found = bucket.candidates(anchors, need.astype(float), focus)
            scores = bucket.scores(anchors, found)
            alike = block.labels[part][:, None] == bucket.labels
            found &= alike if block.same_label else ~alike
            found &= block.rows[part][:, None] != bucket.rows
            found &= (scores >= need[:, None]) & (
                scores <= np.where(wanted, high, NONE).max(axis=1)[:, None])
            anchor, row = np.nonzero(found)
            score, id_ = scores[anchor, row].astype(np.int64), bucket.ids[row]
            for slot in range(low.shape[1]):
                enters = (score <= high[anchor, slot]) & (
                    (score > low[anchor, slot]) | (score == low[anchor, slot]) & (
                        (score > bound[anchor, slot]) | (id_ <= bound_id[anchor, slot])))
                if enters.any():
                    self._enter(slot, start + anchor[enters], score[enters], id_[enters])

    def _enter(self, slot: int, anchor, score, id_) -> None:
        keep = self.block.keep
        held = np.unique(anchor)
        anchor = np.concatenate((np.repeat(held, keep), anchor))
        score = np.concatenate((self.score[held, slot].ravel(), score))
        id_ = np.concatenate((self.id[held, slot].ravel(), id_))
        order = np.lexsort((id_, -score, anchor))
        anchor, score, id_ = anchor[order], score[order], id_[order]
        rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor, "left")
        first = rank < keep
        self.score[anchor[first], slot, rank[first]] = score[first]
        self.id[anchor[first], slot, rank[first]] = id_[first]

    def batch(self) -> pa.RecordBatch:
        anchor, slot, rank = np.nonzero(self.score != NONE)
        at = (anchor, slot, rank)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int32()), pa.array(slot, pa.int32()), pa.array(self.id[at]),
             pa.array(self.score[at])], names=["anchor", "slot", "id", "score"])


def clean(vectors: DataFrame, how: Mining, id_col: str, label_col: str, vector_col: str,
          relabel: Column | None) -> DataFrame:
    """Rows (vec_id, label, v, norm) that take part, v as integers, null ids last."""
    v = F.col(vector_col).cast("array<double>")
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(label_col).cast("long").alias("label"), v.alias("v")).where(
        F.col("label").isNotNull() & F.col("v").isNotNull()).where(
        F.forall("v", lambda x: x.isNotNull())).where(
        F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if relabel is not None:
        kept = kept.withColumn("label", relabel)
    kept = kept.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(how.scale)))))
    return kept.withColumns({
        "vec_id": F.coalesce("vec_id", F.lit(LAST_ID)),
        "norm": F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x.cast("double"))})


def _table(batch, width: int) -> tuple[np.ndarray, ...]:
    """Columns row, vec_id, label, v of an Arrow batch or table; v as a matrix of
    whole numbers that doubles hold exactly."""
    if not batch.num_rows:
        return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros((0, width)))
    column = batch.column("v")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    matrix = np.zeros((len(sizes), width))
    matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return (*(batch.column(c).to_numpy() for c in ("row", "vec_id", "label")), matrix)


def _search(shared, width: int, how: Mining):
    """All of a task's rows, bucket by bucket; its best rows of every slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held = Best(shared.value), []

        def look() -> None:
            parts = [_table(b, width) for b in held]
            if parts:
                best.look(Bucket(*(np.concatenate(c) for c in zip(*parts))), how.focus)

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= how.bucket:
                look()
                held.clear()
                rows = 0
        look()
        yield best.batch()
    return run


def _find(rows: DataFrame, block: Block, width: int, how: Mining) -> list[np.ndarray]:
    """The best rows of each slot: arrays (anchor, slot, rank, id, score)."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    found = rows.select("row", "vec_id", "label", "v").mapInArrow(
        _search(shared, width, how), FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    # At most `keep` rows for each slot of a block.
    table = found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= block.keep).toArrow()
    shared.destroy()
    return [table.column(c).to_numpy().astype(np.int64)
            for c in ("anchor", "slot", "rank", "id", "score")]


def _with_floor(block: Block, found) -> Block:
    """Slots that are full already need nothing worse any more."""
    anchor, slot, rank, id_, score = found
    last = rank == block.keep
    at = (anchor[last], slot[last])
    block.floor_score[at], block.floor_id[at] = score[last], id_[last]
    return block


def _block(anchors: pa.Table, width: int, same_label: bool, keep: int, low: np.ndarray,
           high: np.ndarray) -> Block:
    return Block(*_table(anchors, width), same_label, keep, low, high,
                 np.full(low.shape, NONE), np.full(low.shape, LAST_ID))


def _mine_block(rows: DataFrame, pilot: DataFrame, anchors: pa.Table, width: int,
                how: Mining) -> pa.Table:
    """The result rows of one block of anchors."""
    many = anchors.num_rows
    block = _block(anchors, width, True, how.positives, np.full((many, 1), NONE),
                   np.full((many, 1), LAST_ID))
    block = _with_floor(block, _find(pilot, block, width, how))
    anchor, _, rank, id_, score = _find(rows, block, width, how)
    shape = (many, how.positives)
    positive, reached = np.zeros(shape, np.int64), np.full(shape, NONE)
    positive[anchor, rank - 1], reached[anchor, rank - 1] = id_, score
    there = reached != NONE
    low = np.where(there, -(-reached * how.low // 100), 1)
    high = np.where(there, reached * how.high // 100, 0)
    block = _block(anchors, width, False, how.negatives, low, high)
    block = _with_floor(block, _find(pilot, block, width, how))
    anchor, slot, rank, id_, score = _find(rows, block, width, how)
    ids = [pa.array(x, mask=x == LAST_ID) for x in (block.ids[anchor], positive[anchor, slot], id_)]
    return pa.table([ids[0], ids[1], pa.array(rank, pa.int32()), ids[2],
                     pa.array(reached[anchor, slot]), pa.array(score)], names=RESULT)


def mine(vectors: DataFrame, anchors: Column, how: Mining = Mining(), id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "embedding",
         relabel: Column | None = None) -> DataFrame:
    """Hard negatives of the rows for which `anchors`, an expression over vec_id
    and label, is true. `relabel` replaces label (a long) first.

    Raises ValueError for vectors whose scores doubles cannot hold exactly.
    """
    spark = vectors.sparkSession
    kept = common.stash(clean(vectors, how, id_col, label_col, vector_col, relabel))
    count, most, width = kept.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    if not count:
        return spark.createDataFrame([], EMPTY)
    if most >= 2.0 ** 53:
        raise ValueError(f"a squared length of {most:.4g} is beyond exact scores")
    files = max(-(-count // how.file_rows),
                min(-(-count // how.bucket), spark.sparkContext.defaultParallelism))
    longest = [F.desc("norm"), F.xxhash64("vec_id", "v")]
    rows = common.stash(kept.repartitionByRange(files, *longest).sortWithinPartitions(*longest)
                        .withColumn("row", F.monotonically_increasing_id()))
    pilot = common.stash(rows.orderBy(*longest).limit(how.bucket))
    asking = rows.where(anchors & (F.col("vec_id") != LAST_ID)).select(
        "row", "vec_id", "label", "v")
    blocks = -(-asking.count() * width * 8 // how.block_bytes)
    if not blocks:
        return spark.createDataFrame([], EMPTY)
    asking = common.stash(asking.repartition(blocks).withColumn("block", F.spark_partition_id()))
    found = None
    for block in range(blocks):
        part = asking.where(F.col("block") == block).drop("block").toArrow()
        if not part.num_rows:
            continue
        mined = common.stash(spark.createDataFrame(
            _mine_block(rows, pilot, part, width, how), EMPTY))
        found = mined if found is None else found.union(mined)
    return found
