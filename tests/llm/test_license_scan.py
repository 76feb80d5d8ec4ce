import random

import numpy as np

from shelfline.llm import license_scan, queries
from shelfline.llm.decontamination import words_of

ROOT = "/root/testdata/sf0.01"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


def test_exact_notices(spark):
    """Every verbatim notice of the documents, with its span, and nothing else."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    found = queries.op8_license_scan(spark, ROOT).collect()
    got = {(r.doc_id, r.license, r.start, r.end) for r in found if r.coverage == 1}
    want = set()
    for i, text in texts.items():
        for name, notice in license_scan.TEMPLATES.items():
            notice = notice.rstrip(".")
            at = text.find(notice)
            while at >= 0:
                want.add((i, name, at, at + len(notice)))
                at = text.find(notice, at + 1)
    assert want and got == want
    assert all(r.coverage >= 0.8 and r.start < r.end <= len(texts[r.doc_id]) for r in found)


def test_edited_copies(spark):
    """Copies with words changed, left out and put in, in noise; coverage equals
    the longest common subsequence with the text around."""
    rng = np.random.default_rng(1)
    names = ["MIT-permission", "GPL-3.0-header", "BSD"]
    rows, kept = [], {}
    for i in range(30):
        name = names[i % 3]
        words = license_scan.TEMPLATES[name].split()
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(len(words)))
            words[at:at + 1] = [[], ["zzz"], [words[at], "zzz"]][int(rng.integers(3))]
        noise = " ".join(rng.choice(["foo", "the", "bar", "of"], 40))
        rows.append((i, f"{noise}. {' '.join(words)} {noise}"))
        kept[i] = (name, " ".join(words))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.license): r for r in license_scan.scan(docs).collect()}
    for i, (name, copy) in kept.items():
        template = words_of(license_scan.TEMPLATES[name].encode())
        share = lcs(template, words_of(copy.encode())) / len(template)
        assert share >= 0.8
        row = found.pop((i, name))
        assert row.coverage >= share
        assert abs((row.end - row.start) - len(copy)) < 40
    assert not found


def test_repeated_notice_is_found_each_time(spark):
    notice = license_scan.TEMPLATES["MIT"]
    docs = spark.createDataFrame([(1, "\n".join([notice] * 7))], "doc_id long, text string")
    found = sorted(r.start for r in license_scan.scan(docs).collect())
    assert found == [32 * i for i in range(7)]


def test_odd_documents(odd_documents, no_documents):
    assert license_scan.scan(odd_documents).count() == 0
    found = license_scan.scan(odd_documents, {"x": "same text here"}).collect()
    assert [r.doc_id for r in found].count(4) == 2 and {r.coverage for r in found} == {1.0}
    assert len(found) == 4
    assert license_scan.scan(no_documents).count() == 0


def test_rights_tags_and_whole_texts(spark):
    """Notices written out here, and whole texts, each of which is its own license
    and not the one that differs by a word or a clause."""
    plain = {"rights-reserved": "Copyright 2020 Someone. All rights reserved.",
             "SPDX GPL-2.0-only": "// SPDX-License-Identifier: GPL-2.0-only",
             "SPDX CC-BY-SA-4.0": "# SPDX-License-Identifier: CC-BY-SA-4.0",
             "LGPL-3.0-header": license_scan.TEMPLATES["GPL-3.0-header"].replace(
                 "GNU General", "GNU Lesser General")}
    texts = {x: license_scan.TEMPLATES[x] for x in license_scan.TEMPLATES if x.endswith("-text")}
    names = [*plain, *texts]
    rows = [(i, f"foo bar.\n{(plain | texts)[x]}\nand more") for i, x in enumerate(names)]
    found = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(names[r.doc_id], {})[r.license] = r.coverage
    part = {"MIT-text": {"MIT-permission": 1}, "BSD-2-Clause-text": {"BSD": 1},
            "BSD-3-Clause-text": {"BSD": 1}}
    assert found == {x: {x: 1} | part.get(x, {}) for x in names}


def test_rights_reserved_of_the_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    want = {i for i, t in texts.items() if "All rights reserved." in (t or "")}
    found = queries.op8_license_scan(spark, ROOT).where("license = 'rights-reserved'").collect()
    assert want and {r.doc_id for r in found} == want


def _rows(spark, texts, partitions=1):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(tuple(r)[1:] + (texts[r.doc_id],) for r in license_scan.scan(
        docs.repartition(partitions)).collect())


def test_result_does_not_depend_on_the_other_texts(spark):
    """A copy that lacks its first words, among short and empty texts, in batches
    of every kind."""
    header = license_scan.TEMPLATES["GPL-3.0-header"].split()
    cut = " ".join(header[8:])
    alone = _rows(spark, [cut])
    assert [r[0] for r in alone] == ["GPL-3.0-header"]
    assert _rows(spark, ["x", "y", "z", "", cut, "", "x"]) == alone
    rng = random.Random(3)
    texts = [" ".join(license_scan.TEMPLATES[n].split()[rng.randrange(3):]) for n in
             sorted(license_scan.TEMPLATES)] + [cut, "", "x", "y z"] * 3
    wanted = alone * texts.count(cut)
    found = [_rows(spark, rng.sample(texts, len(texts)), n) for n in (1, 2, 5)]
    assert found[0] == found[1] == found[2]
    assert [r for r in found[0] if r[-1] == cut] == wanted


def test_short_notices_with_a_word_changed(spark):
    texts = ["Released under an MIT License.", "code, released under the MIT Licence"]
    assert {(r[0], r[-1]) for r in _rows(spark, texts)} >= {("MIT", t) for t in texts}


def test_every_edited_copy_of_a_short_template_is_found(spark):
    """All copies of templates of 5 to 12 words with one word changed, lost or added,
    of which the wanted share is left, between other words."""
    rng = random.Random(8)
    templates = {f"t{n}": " ".join(f"w{n}x{i}" for i in range(n)) for n in range(5, 13)}
    texts, wanted = [], set()
    for name, template in templates.items():
        words = template.split()
        for place in range(len(words)):
            for edited in (words[:place] + ["odd"] + words[place + 1:],
                           words[:place] + words[place + 1:],
                           words[:place] + ["odd"] + words[place:]):
                if len(set(edited) & set(words)) >= 0.8 * len(words):
                    wanted.add((len(texts), name))
                texts.append(" ".join(rng.choices(["odd", "other"], k=rng.randrange(4)) + edited
                                      + rng.choices(["odd", "other"], k=rng.randrange(4))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.license) for r in license_scan.scan(docs, templates, 0.8).collect()}
    assert found == wanted and len(wanted) > 150
