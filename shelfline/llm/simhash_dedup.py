"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into two segments, so of two fingerprints that differ in
at most three bits one segment differs in at most one. Each distinct segment
value is indexed under its 32 one-wildcard variants; two values meet under a
variant if they differ in just that bit, so no bucket of that index has more
than two values, however many documents there are. Fingerprints whose segment
values are equal or met are compared in full.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import common

SEED = 42
CHUNK = 1 << 20
# Fingerprints compared in one place; larger groups are cut by their other segment.
GROUP = 256
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_chunks(data: bytes, size: int = CHUNK) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, a bounded piece of it at a time."""
    start = 0
    while start < len(data):
        end = len(data)
        if start + size < end and (gap := _SPACE.search(data, start + size)):
            end = gap.start()
        yield data[start:end].lower().split()
        start = end + 1


def fingerprint(data: bytes | None, shingle: int = 3) -> bytes:
    """Eight bytes: bit by bit the strict majority of the shingles' hashes.
    Zero for a null or a text without words."""
    ones, total, carry = np.zeros(64, np.int64), 0, []
    def count(shingles: list[bytes]) -> None:
        nonlocal total
        for i in range(0, len(shingles), 1 << 14):
            digests = b"".join([xxhash.xxh64_digest(x, SEED) for x in shingles[i:i + (1 << 14)]])
            bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
            ones[:] += bits.sum(axis=0, dtype=np.int64)
        total += len(shingles)
    for words in word_chunks(data or b""):
        words = carry + words
        carry = words[-(shingle - 1):] if shingle > 1 else []
        if len(words) < shingle:
            continue
        ends = list(itertools.accumulate(map(len, words)))
        joined = b" ".join(words)
        count([joined[ends[i] - len(words[i]) + i:ends[i + shingle - 1] + i + shingle - 1]
               for i in range(len(words) - shingle + 1)])
    if not total and carry:
        count([b" ".join(carry)])
    return np.packbits(2 * ones > total).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp) for each row of `docs`; fp is the fingerprint as a
    signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [int.from_bytes(fingerprint(x.as_py(), shingle), "big", signed=True)
                   for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def _forests(most: int):
    """A function from lists of fingerprints to the edges of a spanning forest
    of their links. Each visited one is compared with those not reached yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for fps in batch.column(0):
                rest = np.unique(fps.values.to_numpy())
                while rest.size > 1:
                    root, rest, queue = rest[0], rest[1:], [rest[0]]
                    while queue and rest.size:
                        near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= most
                        a += [int(root)] * int(near.sum())
                        b += rest[near].tolist()
                        queue += list(rest[near])
                        rest = rest[~near]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def fingerprint_links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Rows (a, b): edges that connect just those distinct fingerprints of the
    column `fp` that are linked by steps of at most `most` (up to 3) differing
    bits. Work and rows grow with the distinct fingerprints, not with the
    square of a group: values meet by equality joins, and a group of more than
    GROUP is cut by one-wildcard variants of 16-bit pieces of the other segment,
    below which at most 2**17 values exist."""
    if not 0 <= most <= 3:
        raise ValueError("two segments find up to 3 differing bits")
    low = F.lit(0xFFFFFFFF).cast("long")
    segments = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("s"), F.shiftrightunsigned("fp", 32).alias("value"),
                 F.col("fp").bitwiseAND(low).alias("other")),
        F.struct(F.lit(1).alias("s"), F.col("fp").bitwiseAND(low).alias("value"),
                 F.shiftrightunsigned("fp", 32).alias("other")))).alias("x")
    ).select("fp", "x.*")
    values = common.stash(segments.groupBy("s", "value").agg(F.count(F.lit(1)).alias("n")))
    bit = F.expr("shiftleft(1L, p)")
    variants = values.select("s", "value", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("p"))
    met = variants.select(
        (F.col("value") - F.col("value").bitwiseAND(bit)
         + F.expr("shiftleft(cast(p + 32 * s as bigint), 32)")).alias("k")
    ).groupBy("k").count().where("count = 2").select(
        F.expr("cast(shiftright(k, 37) as int)").alias("s"),
        F.col("k").bitwiseAND(low).alias("u"),
        F.expr("cast(shiftright(k, 32) & 31 as int)").alias("p")
    ).select("s", "u", (F.col("u") + bit).alias("v"))
    pairs = common.stash(met.select("s", "u", "v", F.explode(F.array("u", "v")).alias("value"))
                         .union(values.where("n > 1").select(
                             "s", F.col("value").alias("u"), F.col("value").alias("v"), "value")))
    sized = pairs.join(values, ["s", "value"])
    sizes = sized.groupBy("s", "u", "v").agg(F.sum("n").alias("size"))
    groups = common.stash(sized.join(sizes, ["s", "u", "v"]).select("s", "value", "u", "v", "size"))
    pieces = F.expr(f"""CASE WHEN size <= {GROUP} THEN array(named_struct('sub', -1, 'piece', 0L))
        ELSE transform(sequence(0, 31), p -> named_struct('sub', p, 'piece',
            (shiftright(other, cast(16 * (p div 16) as int)) & 65535L)
            & ~shiftleft(1L, p % 16))) END""")
    members = segments.join(groups, ["s", "value"]).select(
        "fp", "s", "u", "v", F.explode(pieces).alias("x")).select("fp", "s", "u", "v", "x.*")
    lists = members.groupBy("s", "u", "v", "sub", "piece").agg(
        F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps")
    return lists.mapInArrow(_forests(most), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links of at most `most`
    differing bits.

    Null and wordless texts have fingerprint zero and are linked like any
    other; copies share a fingerprint and are never paired; repeated rows come
    out as often as they come in; a null doc_id stays null and does not count
    for a component (null if it has no other); other columns of `docs` are not
    read. An empty table gives an empty result.
    """
    common.prepare(docs.sparkSession)
    prints = common.stash(fingerprints(docs, shingle, id_col, text_col))
    smallest = common.stash(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = common.components(fingerprint_links(smallest.select("fp"), most))
    grouped = smallest.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group"))
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    ids = grouped.join(least, "group").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """`docs` without the near-duplicates of a document with a smaller doc_id.
    Rows that share a doc_id are one document; a null doc_id always stays."""
    gone = near_duplicates(docs, shingle, most).where("component_id < doc_id").select(
        F.col("doc_id").alias("gone")).distinct()
    gone = common.broadcast_if_small(common.stash(gone))
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
