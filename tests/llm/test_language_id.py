import itertools

import numpy as np

from shelfline.llm import language_id as lid
from shelfline.llm import queries

ROOT = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(6)
    lengths = np.array([3, 1, 0, 4])
    scores, step = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    post, expected = lid.forward_backward(scores, lengths, step)
    at, pairs = 0, np.zeros((3, 3))
    for n in lengths:
        weight, total = np.zeros((n, 3)), 0
        moves = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            s = sum(scores[at + t, k] for t, k in enumerate(path))
            p = np.exp(s + sum(step[a, b] for a, b in itertools.pairwise(path)))
            total += p
            for t, k in enumerate(path):
                weight[t, k] += p
            for a, b in itertools.pairwise(path):
                moves[a, b] += p
        if n:
            assert np.allclose(post[at:at + n], weight / total)
            pairs += moves / total
        at += n
    assert np.allclose(expected, pairs)


def test_held_out_accuracy_and_code_switching(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = queries.op3_language_id(spark, ROOT).collect()
    assert len(found) == len(truth)
    tested = [r for r in found if r.held_out]
    assert 0.15 < len(tested) / len(found) < 0.25
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in found)
    model = lid.fit(docs)
    mixed = spark.createDataFrame([(1, "the of and that was with this from " * 4
                                    + "der die und nicht sich einer werden auch " * 4)],
                                  "doc_id long, text string")
    (row,) = lid.label(mixed, model, ["doc_id"]).collect()
    assert [r.lang for r in row.runs][0] == "en" and [r.lang for r in row.runs][-1] == "de"
    assert len(row.runs) <= 4 and row.score < 0.8


def test_held_out_rows_and_labels_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.selectExpr("doc_id", "text", "source", "n_chars",
                              "if(crc32(string(doc_id)) % 5 = 0, 'xx', lang) AS lang")
    small = lid.Sample(docs_per_language=20, words_per_doc=50, sequences=50, iterations=5)
    a, b = lid.fit(docs, small), lid.fit(changed, small)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_odd_documents(spark, odd_documents, no_documents, documents):
    model = lid.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"),
                    lid.Sample(docs_per_language=20, sequences=50, iterations=5))
    rows = lid.label(odd_documents, model, ["doc_id"]).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.row.doc_id: r for r in rows}
    for i in (0, 1, 2, 9, 10, 11):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].runs) == ("und", 0.0, [])
    assert by_id[7].lang_pred in model.languages
    assert lid.label(no_documents, model, ["doc_id"]).count() == 0
    nothing = lid.fit(no_documents)
    assert {r.lang_pred for r in lid.label(odd_documents, nothing, ["doc_id"]).collect()} == {"und"}
    one = lid.fit(documents([(i, "some words here") for i in range(9)]))
    assert {r.lang_pred for r in lid.label(documents(["abc"]), one, ["doc_id"]).collect()} == {"en"}
    kept = lid.drop_rejected(documents([(i, "some words here") for i in range(9)] + [(9, "12 34")]))
    assert kept.count() == 9 and "n_words" in kept.columns
