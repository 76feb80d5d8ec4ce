"""Token ids in files of canonical, length-limited Huffman codes.

A folder has a `codebook` (id, length) and `blocks`. A block is coded by itself,
has at most BLOCK ids and the bit offset of every LANE-th of them, and lists the
pieces of documents that it holds; it can be decoded alone, all lanes at once,
by a table. Blocks of part 0 come first, then those of part 1, and so on.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import bpe, common

MAX_LENGTH = 20
BLOCK = 1 << 16
LANE = 256
END_ID = 1
# Ids decoded in one go.
GROUP = 1 << 20

PIECES = "array<struct<doc_id:bigint,doc:bigint,piece:bigint,n:bigint>>"
BLOCKS = (f"part int, block int, first bigint, n_tokens bigint, docs {PIECES}, "
          "offsets binary, payload binary")


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Code length of each symbol, 0 for a count of 0: the shortest coding with
    no code above `limit` bits, by package-merge. Equal counts rank by symbol."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of the greatest length")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    levels, coins = [], leaves
    for _ in range(limit):
        levels.append(coins)
        packages = coins[: len(coins) & ~1].reshape(-1, 2).sum(axis=1)
        coins = np.concatenate((leaves, packages))
        order = np.argsort(coins, kind="stable")
        coins, is_leaf = coins[order], order < len(leaves)
        levels[-1] = is_leaf
    # levels[k] tells the leaves among the coins of level k + 1; the first has leaves only.
    take = 2 * len(leaves) - 2
    for is_leaf in [*levels[-2::-1], np.ones(len(leaves), bool)]:
        chosen = int(is_leaf[:take].sum())
        lengths[used[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        size = lengths[used].astype(np.int64)
        widest = int(size.max())
        share = 1 << (widest - size)
        codes[used] = (np.cumsum(share) - share) >> (widest - size)
    return codes


@functools.lru_cache(maxsize=1)
def _decode_table(lengths: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length by the next `widest` bits."""
    sizes = np.frombuffer(lengths, np.uint8)
    used = np.flatnonzero(sizes)
    used = used[np.argsort(sizes[used], kind="stable")]
    widest = int(sizes.max(initial=1))
    share = 1 << (widest - sizes[used].astype(np.int64))
    symbols, steps = np.zeros(1 << widest, np.int32), np.ones(1 << widest, np.uint8)
    symbols[:share.sum()] = np.repeat(used, share)
    steps[:share.sum()] = np.repeat(sizes[used], share)
    return symbols, steps, widest


def pack_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Payload and the bit offsets of every LANE-th id."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    total = (int(ends[-1]) + 7) // 8 if len(ids) else 0
    out = np.zeros(total + 4, np.float64)
    # A code of up to 25 bits touches four bytes; no bit is written twice.
    value = codes[ids].astype(np.int64) << (32 - sizes - (starts & 7))
    for k in range(4):
        out += np.bincount((starts >> 3) + k, weights=(value >> (24 - 8 * k)) & 255,
                           minlength=total + 4)
    return out[:total].astype(np.uint8).tobytes(), starts[::LANE].astype("<u4").tobytes()


def unpack_blocks(blocks: list[tuple[int, bytes, bytes]], lengths: bytes) -> list[np.ndarray]:
    """The ids of blocks (n, offsets, payload), all their lanes side by side."""
    symbols, steps, widest = _decode_table(lengths)
    payload = np.frombuffer(b"".join(x for _, _, x in blocks) + bytes(8), np.uint8)
    view = payload.astype(np.uint64)
    window = (view[:-4] << 32) | (view[1:-3] << 24) | (view[2:-2] << 16) | (view[3:-1] << 8) | view[4:]
    base = np.cumsum([0] + [8 * len(x) for _, _, x in blocks])
    lanes = [np.frombuffer(o, "<u4").astype(np.int64) + b
             for (_, o, _), b in zip(blocks, base[:-1], strict=True)]
    at = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
    out = np.zeros((LANE, len(at)), np.int32)
    shift, mask, last = np.uint64(40 - widest), np.uint64((1 << widest) - 1), len(window) - 1
    for i in range(LANE):
        # Lanes past their end read on; what they find is cut off.
        byte = np.minimum(at >> 3, last)
        prefix = (window[byte] >> (shift - (at & 7).astype(np.uint64))) & mask
        out[i] = symbols[prefix]
        at += steps[prefix]
    found, lane = [], 0
    for n, offsets, _ in blocks:
        count = len(offsets) // 4
        found.append(out[:, lane:lane + count].T.reshape(-1)[:n])
        lane += count
    return found


def joined_crc(pieces: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from (CRC-32, bytes) of its pieces."""
    crc, zeros = 0, bytes(1 << 16)

    def padded(value: int, size: int) -> int:
        while size > 0:
            value = zlib.crc32(zeros[:min(size, len(zeros))], value)
            size -= len(zeros)
        return value
    for i, (found, size) in enumerate(pieces):
        crc = found if i == 0 else padded(crc, size) ^ padded(0, size) ^ found
    return crc


def token_ids(docs: DataFrame, path: str, id_col: str, text_col: str,
              end_id: int, dtype: str) -> DataFrame:
    """Rows (doc_id, ids), the ids of the tokenizers library and the end id."""
    end = np.array([end_id], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.library_encoder(path, dtype)
        for batch in batches:
            ids = [encoder.encode(x.as_py()) + end for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def count_ids(ids: DataFrame, size: int, dtype: str) -> np.ndarray:
    """How often each of `size` ids occurs; tasks send at most one row an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype)
            counts += np.bincount(found, minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])
    found = np.zeros(size, np.int64)
    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n"))
    for i, n in rows.toLocalIterator():
        found[i] = n
    return found


def _write_blocks(lengths: bytes, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.frombuffer(lengths, np.uint8)
        codes, part = canonical_codes(sizes), TaskContext.get().partitionId()
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "doc", "piece", "n")]))
        held, docs, room, number, first = [], [], BLOCK, 0, 0

        def block() -> pa.RecordBatch:
            nonlocal held, docs, room, number, first
            ids = np.concatenate(held)
            payload, offsets = pack_block(ids, codes, sizes)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([docs], kind),
                 pa.array([offsets], pa.binary()), pa.array([payload], pa.binary())],
                names=["part", "block", "first", "n_tokens", "docs", "offsets", "payload"])
            held, docs, room, number, first = [], [], BLOCK, number + 1, first + len(ids)
            return out
        doc = 0
        for batch in batches:
            for name, x in zip(batch.column(0), batch.column(1), strict=True):
                ids, at, piece = np.frombuffer(x.as_py(), dtype), 0, 0
                while at < len(ids):
                    taken = ids[at:at + room]
                    held.append(taken)
                    docs.append({"doc_id": name.as_py(), "doc": doc, "piece": piece,
                                 "n": len(taken)})
                    room, at, piece = room - len(taken), at + len(taken), piece + 1
                    if not room:
                        yield block()
                doc += 1
        if held:
            yield block()
    return run


@dataclass(frozen=True)
class IdFiles:
    """A written folder."""
    folder: str
    dtype: str


def write_ids(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id",
              text_col: str = "text", end_id: int = END_ID) -> IdFiles:
    """Encode `docs` and write the ids in ascending order of doc_id (nulls
    first, ties by the hash of the ids) below `folder`.

    A null or empty text has the end id alone; repeated rows are written
    each; other columns are not read; an empty table gives files without blocks.
    """
    spark = common.prepare(docs.sparkSession)
    size = max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True), end_id + 1)
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    ids = common.stash(token_ids(docs, path, id_col, text_col, end_id, dtype))
    lengths = code_lengths(count_ids(ids, size, dtype))
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths) if x],
                          "id int, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    # The tie also splits a doc_id that very many rows share.
    order = ["doc_id", F.xxhash64("ids")]
    ids.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _write_blocks(lengths.tobytes(), dtype), BLOCKS).write.parquet(f"{folder}/blocks")
    return IdFiles(folder, dtype)


def _read_pieces(lengths: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            while rows:
                n, group = 0, []
                while rows and (not group or n + rows[0]["n_tokens"] <= GROUP):
                    group.append(rows.pop(0))
                    n += group[-1]["n_tokens"]
                found = unpack_blocks(
                    [(x["n_tokens"], x["offsets"], x["payload"]) for x in group], lengths)
                out = []
                for row, ids in zip(group, found, strict=True):
                    at, data = 0, memoryview(ids.astype("<u4").tobytes())
                    for x in row["docs"]:
                        crc = zlib.crc32(data[4 * at:4 * (at + x["n"])])
                        out.append((row["part"], *x.values(), row["first"] + at, crc))
                        at += x["n"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                    names=["part", "doc_id", "doc", "piece", "n", "begin", "crc"])
    return run


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [joined_crc([(p["crc"], 4 * p["n"]) for p in x.as_py()])
               for x in batch.column("pieces")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("part", "doc_id", "begin", "n_tokens")]
            + [pa.array(crc, pa.int64())],
            names=["part", "doc_id", "begin", "n_tokens", "ids_crc32"])


def read_codebook(spark: SparkSession, files: IdFiles) -> bytes:
    rows = spark.read.schema("id int, length int").parquet(f"{files.folder}/codebook").collect()
    lengths = np.zeros(max((r.id for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r.id] = r.length
    return lengths.tobytes()


def read_ids(spark: SparkSession, files: IdFiles) -> DataFrame:
    """Rows (part, block, doc_id, doc, piece, ids) of the files, ids as
    little-endian unsigned 32-bit integers: the documents in pieces of at most
    BLOCK ids."""
    lengths = read_codebook(spark, files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (ids,) = unpack_blocks([(row["n_tokens"], row["offsets"], row["payload"])], lengths)
                at, out = 0, []
                for x in row["docs"]:
                    out.append((row["part"], row["block"], x["doc_id"], x["doc"], x["piece"],
                                ids[at:at + x["n"]].astype("<u4").tobytes()))
                    at += x["n"]
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["part", "block", "doc_id", "doc", "piece", "ids"])
    return spark.read.schema(BLOCKS).parquet(f"{files.folder}/blocks").mapInArrow(
        run, "part long, block long, doc_id long, doc long, piece long, ids binary")


def document_digests(spark: SparkSession, files: IdFiles) -> DataFrame:
    """Of each written document, decoded from the files: doc_id, start (ids of
    all documents before it), n_tokens and the CRC-32 of its ids."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{files.folder}/blocks")
    # One number for each part; there are as many parts as writing tasks.
    sizes = {p: n for p, n in blocks.groupBy("part").agg(F.sum("n_tokens")).toLocalIterator()}
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    pieces = blocks.mapInArrow(
        _read_pieces(read_codebook(spark, files)),
        "part long, doc_id long, doc long, piece long, n long, begin long, crc long")
    whole = pieces.groupBy("part", "doc", "doc_id").agg(
        F.sum("n").alias("n_tokens"), F.min("begin").alias("begin"),
        F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("pieces"))
    found = whole.mapInArrow(
        _join_pieces, "part long, doc_id long, begin long, n_tokens long, ids_crc32 long")
    offsets = spark.createDataFrame(offsets, "part long, before long")
    return found.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
