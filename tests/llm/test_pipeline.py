import __spark_entry__ as entry
import corpus_pipeline
from shelfline.llm import common, queries


def test_registered():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == [*range(1, 14)]
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages_hold_together(spark):
    root = "/root/testdata/sf0.001"
    common.prepare(spark)
    docs = common.table(spark, root, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stash(stage(spark, docs, root))
        counts.append(docs.count())
        assert name == "bpe" or docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.8 * counts[0]
    assert sorted(map(tuple, corpus_pipeline.run(spark, root).collect())) == sorted(
        map(tuple, docs.collect()))


def test_components(spark):
    edges = [(1, 2), (3, 2), (3, 4), (9, 10), (7, 7), (10, 9), (10, 11)]
    edges += [(100 + i, 101 + i) for i in range(60)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {**{i: 1 for i in (1, 2, 3, 4)}, **{i: 9 for i in (9, 10, 11)},
            **{i: 100 for i in range(100, 161)}}
    assert {r.node: r.component for r in found} == want and len(found) == len(want)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
