import math
import random
import re

from pyspark.sql import functions as F

from shelfline.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(kind, m.start(), m.end(), m.group()) for kind, p in PATTERNS.items()
            for m in re.finditer(p, text or "") if valid(kind, m.group())]


def base_of(docs):
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    rows = pii.with_base_spans(docs).select("id", "base").collect()
    return {r.id: [(pii.KINDS[k], s, e, v) for k, s, e, v in r.base] for r in rows}


def test_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a", "b@", "@", "c.d", "1", "4", "111", "4111111111111111", " ", "-", ".", "+",
             "+1 (212) 555-1234", "x.y@z.com", "a@b.c+d@e.f", "256.1.1.1", "1.2.3.4.5",
             "00001.02.3.255", "é", "😀", "\n", "(", ")", "4111 1111-1111 1111",
             "5500000000000004", "9"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(2000)]
    texts += [None, "", "9" * 30_000, "a" * 50_000, "1 " * 20_000, "a@b.co " * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    assert base_of(docs) == {i: brute(t) for i, t in enumerate(texts)}


def test_query_equals_plain_patterns(spark):
    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    for r in queries.op9_pii(spark, root).collect():
        want = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for k, *_ in want) for kind in pii.KINDS]
        spans = [x for x in r.spans.split(",") if x and not x.startswith("term")]
        assert spans == [f"{k}:{s}:{e}" for k, s, e, _ in want]


def test_disclosing_terms(spark):
    """"zorro" stands only beside one address, "known" beside it and, in three rows,
    elsewhere; common words, and words beside it too seldom, reveal nothing."""
    rows = [(i, f"call the zorro known a{i % 2}b x.y@z.com the end {'rare' if i < 2 else ''}")
            for i in range(6)]
    rows += [(i, "the end is known to all" if i < 9 else "the end of things") for i in range(6, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.sanitise(docs, support=3, generalise=0.7, remove=0.95)
             .collect()}
    n, value = 60, 6
    share = lambda both, term: math.log2(both * n / (value * term)) / math.log2(n / value)
    assert share(6, 6) == 1 and 0.7 < share(6, 9) < 0.95 and share(6, 60) < 0.7
    spans = [(x.kind, x.value) for x in found[0].spans]
    assert spans == [(0, "x.y@z.com"), (4, "call"), (4, "zorro"), (5, "known")]
    assert found[0].sanitised == "  the  [term] a0b [email] the end rare".replace("  the", " the", 1)
    assert all(not found[i].spans and found[i].sanitised == dict(rows)[i] for i in range(6, 60))


def test_odd_documents(odd_documents, no_documents):
    found = pii.sanitise(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert all(r.sanitised is not None for r in found)
    assert pii.sanitise(no_documents).count() == 0


def test_terms_far_away_and_rare_values(spark):
    """The signature, hundreds of words from the address, and the only holder's
    name, joined to a digit, reveal values; words of all documents do not."""
    common = "the end of all common things " * 60
    rows = [(i, f"{i % 7} p.q@z.com {common} Zorrosign") for i in range(4)]
    rows += [(4, f"Mustername2 {common} call +1 (212) 555-1234")]
    rows += [(i, common) for i in range(5, 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.sanitise(docs).where("doc_id < 10").collect()}
    for i in range(4):
        assert [(x.kind, x.value) for x in found[i].spans] == [(0, "p.q@z.com"), (4, "Zorrosign")]
    # One row: the estimate is log2(2000 / 2) / log2(2000) = 0.909.
    assert [(x.kind, x.value) for x in found[4].spans] == [
        (3, "+1 (212) 555-1234"), (4, "Mustername"), (4, "call")]
    assert all(not found[i].spans for i in range(5, 10))


def test_places_of_very_many_matches(spark):
    """A text of 1 MB with 80,000 addresses: by stretches, so time follows the text."""
    text = " ".join(f"a{i}@b.cc" for i in range(80_000))
    docs = spark.createDataFrame([(1, text), (2, text[:700]), (3, "")], "doc_id long, text string")
    found = pii.with_base_spans(docs).select("doc_id", "base.s", "base.e").collect()
    for r in found:
        body = {1: text, 2: text[:700], 3: ""}[r.doc_id]
        places = [m.span() for m in re.finditer(r"\S+@\S+\.\S+", body)]
        assert list(zip(r.s, r.e)) == places
