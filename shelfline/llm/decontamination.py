"""Benchmark decontamination by suffix arrays of the training text.

Each task builds suffix arrays over shards of whole documents and binary-searches
every suffix of the test items in them. All occurrences of an item's window
of words form one range of the array; each is extended to its longest verbatim
match. Suffixes that begin with a word no test item has are left out of the
array, since no test suffix can equal them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import common

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20
MATCH = "array<struct<doc_start:bigint,item_start:bigint,length:bigint,item_id:bigint>>"

# Letters and digits of ASCII, and every byte of a longer character, are in words.
_WORDS_ONLY = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c > 127 else 32
                    for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_WORDS_ONLY).split()


class TestItems:
    """The test items of one block as word numbers, with the searched suffixes."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        words = [(i, w) for i, text in items if (w := words_of(text))]
        self.vocabulary = {x: n for n, x in enumerate(
            sorted({x for _, w in words for x in w}), 1)}
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.packed = 63 // self.bits
        self.longest = max((len(w) for _, w in words), default=0)
        self.item_ids = [i for i, _ in words]
        sizes = np.array([len(w) for _, w in words], np.int64)
        pad = window + self.longest + self.packed
        # Items are set apart by 0, which no word has.
        self.ids = np.zeros(int(sizes.sum()) + len(sizes) + pad, np.int64)
        begins, at = [], 0
        for _, w in words:
            self.ids[at:at + len(w)] = [self.vocabulary[x] for x in w]
            begins.append(at)
            at += len(w) + 1
        need = np.minimum(sizes, window)
        count = sizes - need + 1
        self.item = np.repeat(np.arange(len(sizes)), count)
        begin = np.repeat(np.array(begins, np.int64), count)
        self.offset = np.arange(len(self.item)) - np.repeat(np.cumsum(count) - count, count)
        self.start = begin + self.offset
        self.need = need[self.item] if len(sizes) else need
        self.keys = self.pack(self.ids)

    def pack(self, ids: np.ndarray) -> np.ndarray:
        """At each place, the numbers of the next words in one integer."""
        keys = np.zeros(len(ids), np.int64)
        for j in range(self.packed):
            keys[:len(ids) - j] += ids[j:] << (self.bits * (self.packed - 1 - j))
        return keys


def suffix_array(keys: np.ndarray, starts: np.ndarray, items: TestItems) -> np.ndarray:
    """`starts` sorted by the words that follow, as far as a test item reaches.
    Ties of the packed words are sorted by the next ones."""
    step, last = items.packed, (1 << items.bits) - 1
    order = starts[np.argsort(keys[starts], kind="stable")]
    k = keys[order]
    group = np.concatenate(([0], np.cumsum(k[1:] != k[:-1]))) if len(k) else k
    places, depth = np.arange(len(order)), step
    while depth < items.longest and len(places):
        # A word of no item ends every match, so the order behind it is free.
        size = np.bincount(group)
        tied = (size[group] > 1) & ((keys[order[places] + depth - step] & last) > 0)
        places, group = places[tied], group[tied]
        if not len(places):
            break
        k = keys[order[places] + depth]
        by = np.lexsort((k, group))
        order[places] = order[places][by]
        k, group = k[by], group[by]
        group = np.concatenate(([0], np.cumsum((k[1:] != k[:-1]) | (group[1:] != group[:-1]))))
        depth += step
    return order


def _bound(keys: np.ndarray, order: np.ndarray, items: TestItems, upper: bool) -> np.ndarray:
    """Where the suffixes that begin with each test window begin or end."""
    low = np.zeros(len(items.start), np.int64)
    high = np.full(len(items.start), len(order), np.int64)
    levels = -(-int(items.need.max()) // items.packed)
    for _ in range(len(order).bit_length()):
        mid = (low + high) >> 1
        open_ = low < high
        at = order[np.minimum(mid, len(order) - 1)]
        before, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for level in range(levels):
            words = np.clip(items.need - level * items.packed, 0, items.packed)
            drop = items.bits * (items.packed - words)
            mine = keys[at + level * items.packed] >> drop
            theirs = items.keys[items.start + level * items.packed] >> drop
            before |= same & (mine < theirs)
            same &= mine == theirs
        right = open_ & (before | (same & upper))
        low = np.where(right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    return low


def search_shard(ids: np.ndarray, items: TestItems) -> tuple[np.ndarray, ...]:
    """All maximal matches of a window or more: places in the shard, test
    suffixes and lengths. `ids` ends in zeros."""
    starts = np.flatnonzero(ids)
    if not len(starts) or not len(items.start):
        return (np.zeros(0, np.int64),) * 3
    keys = items.pack(ids)
    order = suffix_array(keys, starts, items)
    low, high = _bound(keys, order, items, False), _bound(keys, order, items, True)
    count = high - low
    query = np.repeat(np.arange(len(count)), count)
    place = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(query))]
    # Of a match only its first window is kept.
    begin = items.start[query]
    left = ids[np.maximum(place - 1, 0)]
    inner = (place > 0) & (items.offset[query] > 0) & (left == items.ids[begin - 1]) & (left > 0)
    query, place, begin = query[~inner], place[~inner], begin[~inner]
    length = items.need[query].copy()
    going = np.arange(len(query))
    while len(going):
        following = items.ids[begin[going] + length[going]]
        going = going[(following > 0) & (following == ids[place[going] + length[going]])]
        length[going] += 1
    return place, query, length


def _scan(block, window: int, last: bool):
    def flush(rows: list[tuple], items: TestItems) -> list[pa.Array]:
        sizes = np.array([len(x) for x, _ in rows], np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        pad = window + items.longest + items.packed + 1
        ids = np.zeros(int(begins[-1] + sizes[-1]) + pad, np.int64)
        for begin, (x, _) in zip(begins, rows, strict=True):
            ids[begin:begin + len(x)] = x
        place, query, length = search_shard(ids, items)
        doc = np.searchsorted(begins, place, side="right") - 1
        found = [list(old) for _, old in rows]
        for d, p, q, n in zip(doc.tolist(), (place - begins[doc]).tolist(), query.tolist(),
                              length.tolist(), strict=True):
            found[d].append({"doc_start": p, "item_start": int(items.offset[q]), "length": n,
                             "item_id": items.item_ids[items.item[q]]})
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in
                                   ("doc_start", "item_start", "length", "item_id")]))
        return [pa.array(sizes, pa.int64()), pa.array(found, kind)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = TestItems(block.value, window)
        held, rows, words = [], [], 0
        def shard():
            kept = pa.concat_batches(held)
            texts = pa.nulls(len(rows), pa.binary()) if last else kept.column(1)
            return pa.RecordBatch.from_arrays(
                [kept.column(0), texts, *flush(rows, items)],
                names=["row", "text", "n_words", "matches"])
        for batch in batches:
            at = 0
            for i, (text, old) in enumerate(zip(batch.column(1), batch.column(3), strict=True)):
                found = words_of(text.as_py())
                numbers = np.fromiter(map(items.vocabulary.get, found, (0 for _ in found)),
                                      np.int64, len(found))
                rows.append((numbers, old.as_py()))
                words += len(found)
                if words >= SHARD_WORDS:
                    held.append(batch.slice(at, i + 1 - at))
                    yield shard()
                    held, rows, words, at = [], [], 0, i + 1
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if rows:
            yield shard()
    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The test items in blocks of bounded size; the driver holds one at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    for item, text in rows.toLocalIterator():
        block.append((item, bytes(text or b"")))
        size += len(block[-1][1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW,
                 text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """For each row of `docs`: `row` (a struct of the columns `keep`), n_words,
    n_hit (words inside a match) and `matches`, every maximal verbatim match
    (doc_start, item_start, length, item_id, in words) of at least `window`
    words, or of a whole item with fewer.

    Null and empty texts have no words and no matches. Texts are searched
    whole, whatever their length. Equal items and repeated rows each have their
    own matches; the matches of an item without an id have a null item_id. An
    empty benchmark gives no matches, an empty table no rows. Only the named
    columns are read, so other columns cannot clash.
    """
    spark = common.prepare(docs.sparkSession)
    schema = "row {0}, text binary, n_words bigint, matches {1}"
    found = docs.select(F.struct(*keep).alias("row"),
                        F.col(text_col).cast("binary").alias("text"),
                        F.lit(0).cast("long").alias("n_words"),
                        F.expr(f"cast(array() as {MATCH})").alias("matches"))
    schema = schema.format(found.schema["row"].dataType.simpleString(), MATCH)
    # Test items that don't fit in one block take another pass over the rows.
    blocks = _blocks(benchmark, item_id_col, item_text_col)
    block = next(blocks, [])
    while block is not None:
        following = next(blocks, None)
        scan = _scan(spark.sparkContext.broadcast(block), window, last=following is None)
        found, block = found.mapInArrow(scan, schema), following
    covered = """aggregate(array_sort(matches),
        named_struct('reach', 0L, 'hit', 0L), (a, m) -> named_struct(
            'reach', greatest(a.reach, m.doc_start + m.length),
            'hit', a.hit + greatest(0L, m.doc_start + m.length
                                        - greatest(a.reach, m.doc_start)))).hit"""
    return found.select("row", "n_words", F.expr(covered).alias("n_hit"), "matches")


def judge(found: DataFrame) -> DataFrame:
    """Adds the items with matches, and whether a twentieth of the words is in them."""
    return found.withColumn(
        "items", F.array_compact(F.array_distinct(F.expr("transform(matches, m -> m.item_id)")))
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the rows that are contaminated."""
    return judge(find_matches(docs, benchmark, docs.columns, window)).where(
        "not contaminated").select("row.*")
