import re

import numpy as np
import xxhash

from shelfline.llm import simhash_dedup


def brute_fingerprint(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=3):
    parent = {p: p for p in prints}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= most:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    root = brute_components(set(prints.values()))
    least = {}
    for i, p in sorted(prints.items()):
        least.setdefault(root[p], i)
    found = simhash_dedup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (i, f"{p:016x}", least[root[p]]) for i, p in prints.items()}


def test_links_of_dense_groups(spark):
    """Groups above and below the size at which they are cut up."""
    rng = np.random.default_rng(5)
    prints = set()
    for size in (40, 900):
        base = int(rng.integers(1 << 63))
        for _ in range(size):
            prints.add(base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash_dedup.fingerprint_links(spark.createDataFrame(signed, "fp long")).collect()
    parent = {p: p for (p,) in signed}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[find(a)] = find(b)
    want = brute_components(prints)
    groups = {}
    for (p,) in signed:
        groups.setdefault(find(p), set()).add(want[p % (1 << 64)])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_odd_documents(odd_documents, no_documents):
    found = simhash_dedup.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[0].fingerprint == by_id[1].fingerprint == "0" * 16
    assert by_id[1].component_id == by_id[2].component_id == 0
    assert by_id[4].component_id == by_id[5].component_id == 4
    assert {r.component_id for r in found if r.doc_id is None} == {0, 4}
    assert simhash_dedup.near_duplicates(no_documents).count() == 0
    kept = simhash_dedup.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (0, 1, 2, 4, 5)) == [0, 4, 4]
