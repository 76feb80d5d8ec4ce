import numpy as np
import pytest

import compare
from shelfline.llm import decontamination as dec
from shelfline.llm import queries

ROOT = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    df = queries.op1_decontamination(spark, ROOT)
    con, sql = compare.oracle_connection(ROOT), queries.ORACLE_SQL["op1_decontamination"]
    assert compare.spark_rows(df) == compare.oracle_rows(con, sql)
    assert compare.spark_types(df) == compare.oracle_types(con, sql)


def brute(texts, items, window):
    """Maximal matches by comparing every place with every place."""
    found = []
    for d, text in texts:
        words = dec.words_of(text.encode())
        for i, item in items:
            test = dec.words_of(item.encode())
            need = min(window, len(test))
            for a in range(len(words)):
                for b in range(len(test) if need else 0):
                    n = 0
                    while a + n < len(words) and b + n < len(test) and words[a + n] == test[b + n]:
                        n += 1
                    if n >= need and not (a and b and words[a - 1] == test[b - 1]):
                        found.append((d, a, b, n, i))
    return sorted(found)


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_matches_equal_brute_force(spark, monkeypatch, block):
    """Few different words, so that matches are many, long and overlapping; one
    and several blocks of test items; shards that end within a batch."""
    monkeypatch.setattr(dec, "BLOCK_BYTES", block)
    monkeypatch.setattr(dec, "SHARD_WORDS", 50)
    rng = np.random.default_rng(3)
    def text(n):
        return " ".join(rng.choice(["a", "b", "A.", "b2", "é"], n))
    items = [(i, text(n)) for i, n in enumerate((1, 3, 5, 9, 14, 30))]
    texts = [(i, text(n)) for i, n in enumerate((0, 1, 4, 20, 60, 90))]
    texts.append((9, f"start {items[5][1]} end"))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = dec.find_matches(docs, tests, ["doc_id"], window=4).collect()
    assert sorted((r.row.doc_id, *m) for r in found for m in r.matches) == brute(texts, items, 4)


def test_odd_documents(spark, odd_documents, no_documents):
    tests = spark.createDataFrame(
        [(1, "same text"), (None, "word word word"), (2, None), (3, ""), (1, "same text")],
        "item_id long, text string")
    found = dec.judge(dec.find_matches(odd_documents, tests, ["doc_id"], 13)).collect()
    assert len(found) == odd_documents.count()
    by_id = {r.row.doc_id: r for r in found}
    assert by_id[4].n_hit == 2 and by_id[4]["items"] == [1] and by_id[4].contaminated
    assert by_id[7].n_hit == 30_000 and by_id[7]["items"] == []
    assert by_id[0].n_words == 0 and not by_id[0].contaminated
    assert dec.find_matches(no_documents, tests, ["doc_id"]).count() == 0
    kept = dec.drop_contaminated(odd_documents, tests)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 5
    assert dec.drop_contaminated(odd_documents, tests.limit(0)).count() == odd_documents.count()
