import numpy as np
import pytest

from shelfline.llm import ann, queries


def brute(vectors, asked, k=20):
    ids = np.array(sorted(vectors))
    points = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in asked:
        scores = (points * np.array(vectors[q], float)).sum(axis=1)
        best = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), scores[j]) for j in best]
    return out


def lists(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def recall(found, want):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in w}) / len(w)
                    for q, w in want.items()])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    root = f"/root/testdata/{sf}"
    vectors = {r.vec_id: r.embedding
               for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()}
    want = brute(vectors, [i for i in vectors if i % 20 == 0])
    found = lists(queries.op2_ann(spark, root).collect())
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    assert recall(found, want) >= 0.9
    for q, pairs in found.items():
        for i, score in pairs:
            assert abs(score - np.dot(np.array(vectors[q], float), vectors[i])) < 1e-12


def test_all_lists_probed_is_exact_with_ties_and_norms(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(9)
    vectors = {i: (rng.normal(size=8) * rng.uniform(0.1, 9)).tolist() for i in range(300)}
    vectors |= {i: [1.0] * 8 for i in range(300, 420)}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    asked = [0, 20, 300, 419]
    search = ann.Search(neighbours=5, probes=1.0, pilot=10, first=2, per_list=20, error=50.0)
    found = lists(ann.nearest(frame, frame.where(frame.vec_id.isin(asked)), search).collect())
    want = brute(vectors, asked, 5)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {
        q: [i for i, _ in v] for q, v in want.items()}


def test_abandoning_is_safe_at_the_bound():
    rng = np.random.default_rng(2)
    points, queries_ = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    far = ((points[None] - queries_[:, None]) ** 2).sum(axis=2)
    bound = np.sort(far, axis=1)[:, 19]
    rows, places = ann.scan(points, queries_, bound, 16, 2.1)
    kept = set(zip(rows.tolist(), places.tolist(), strict=True))
    near = {(q, p) for q, p in np.argwhere(far <= bound[:, None]).tolist()}
    assert len(kept & near) >= 0.95 * len(near) and kept <= near


def test_odd_vectors(spark):
    kind = "vec_id long, embedding array<double>, v string, list int, norm string, rank int"
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]),
            (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (7, [0.9, 0.0]), (40, None)]
    frame = spark.createDataFrame([(*r, "v", 1, "n", 2) for r in rows], kind)
    found = lists(ann.nearest(frame, frame.where("vec_id % 20 = 0")).collect())
    assert found == {20: [(7, 0.9), (1, 0.5)]}
    assert ann.nearest(frame.limit(0), frame).count() == 0


def test_unequal_lengths_and_ids_with_several_vectors(spark):
    rows = [(20, [1.0, 0.25]), (1, [0.5, 0.5]), (8, [0.95]), (9, [0.1, 0.1, 5.0]),
            (3, [0.7, 0.0]), (3, [0.2, 0.0]), (3, [0.9, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for _ in range(2):
        found = lists(ann.nearest(frame, frame.where("vec_id % 20 = 0")).collect())
        assert found == {20: [(8, 0.95), (1, 0.625), (3, 0.2), (9, 0.125)]}
