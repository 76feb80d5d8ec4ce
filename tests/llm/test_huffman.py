import heapq
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from shelfline.llm import common, huffman, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def test_code_lengths():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 1000, 300)
    assert (huffman.code_lengths(counts, 20).astype(int) * counts).sum() == best_cost(counts)
    steep = np.array([2 ** i for i in range(30)])
    for limit in (5, 8, 20):
        lengths = huffman.code_lengths(steep, limit)
        assert lengths.max() <= limit and sum(2.0 ** -lengths.astype(float)) == 1
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    assert huffman.code_lengths(np.zeros(3, int)).tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, int), 2)


def test_blocks_decode_alone():
    rng = np.random.default_rng(4)
    counts = rng.zipf(1.2, 400).astype(np.int64)
    lengths = huffman.code_lengths(counts, 12)
    codes = huffman.canonical_codes(lengths)
    for size in (1, 255, 256, 257, 5000):
        ids = rng.integers(0, 400, size)
        offsets, payload = reversed(huffman.pack_block(ids, codes, lengths))
        (found,) = huffman.unpack_blocks([(size, offsets, payload)], lengths.tobytes())
        assert found.tolist() == ids.tolist()


def test_joined_crc():
    data = bytes(range(256)) * 900
    parts = [data[:5], data[5:70_000], b"", data[70_000:]]
    assert huffman.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(data)


def expected(texts):
    library, at, out = Tokenizer.from_file(PATH), 0, {}
    for i, text in sorted(texts.items()):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("block", [300, 1 << 16])
def test_query_equals_library(spark, monkeypatch, block):
    monkeypatch.setattr(huffman, "BLOCK", block)
    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32)
             for r in queries.op4_huffman_ids(spark, root).collect()}
    assert found == expected(texts)


def test_odd_documents(spark, odd_documents, no_documents):
    files = huffman.write_ids(odd_documents, PATH, common.shared_folder(spark))
    rows = sorted(huffman.document_digests(spark, files).collect(), key=lambda r: r.start)
    assert len(rows) == odd_documents.count()
    assert [r.doc_id is None for r in rows] == [True, True] + [False] * (len(rows) - 2)
    ids = [r.doc_id for r in rows[2:]]
    assert ids == sorted(ids)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    pieces = huffman.read_ids(spark, files).collect()
    assert sum(len(r.ids) for r in pieces) == 4 * sum(r.n_tokens for r in rows)
    files = huffman.write_ids(no_documents, PATH, common.shared_folder(spark))
    assert huffman.document_digests(spark, files).count() == 0
