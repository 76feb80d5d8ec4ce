"""License scans: winnowed fingerprints pick candidates, alignment decides.

Templates and texts are cut into word n-grams, of whose hashes the smallest in
each window is a fingerprint; a run of GRAM + WINDOW - 1 words that both have
shares one. An inverted index of the templates' fingerprints gives, for a text,
the templates and diagonals to look at, and an alignment in a band around each
diagonal gives the matched words and their span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import common
from shelfline.llm.decontamination import SHARD_WORDS, words_of

GRAM, WINDOW = 3, 2
# Templates of fewer words are looked up by every one of their shorter grams: a copy
# with a word changed may have no longer one in common.
SHORT, SHORT_GRAM = 8, 2
COVERAGE = 0.8
MEMO = 100_000
# The words of decontamination.words_of, in a text of characters.
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

_GPL = """This program is free software: you can redistribute it and/or modify it
    under the terms of the GNU {} as published by the Free Software Foundation, either
    version {} of the License, or (at your option) any later version."""
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
_AS_IS = """{} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
    THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
    DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
    LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
    BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
    STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
    USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification,
    are permitted provided that the following conditions are met: Redistributions of source code
    must retain the above copyright notice, this list of conditions and the following disclaimer.
    Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution. """
_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be
    used to endorse or promote products derived from this software without specific prior written
    permission. """
_HOLDERS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"
# The tags that files carry, with the name of the license in the list of SPDX.
SPDX = ["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
        "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause",
        "BSD-3-Clause", "ISC", "Zlib", "MPL-2.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0",
        "CC-BY-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-4.0", "Unlicense"]

# Notices by which works state their license, and whole texts of
# licenses that are usually pasted whole.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": """Permission is hereby granted, free of charge, to any person obtaining
        a copy of this software and associated documentation files (the "Software"), to deal in
        the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following
        conditions:""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.""",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": """This work is licensed under a Creative Commons Attribution 4.0 International
        License.""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met:""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0.""",
    "rights-reserved": "All rights reserved.",
    "GPL-2.0-header": _GPL.format("General Public License", "2"),
    "LGPL-2.1-header": _GPL.format("Lesser General Public License", "2.1"),
    "LGPL-3.0-header": _GPL.format("Lesser General Public License", "3"),
    "AGPL-3.0-header": _GPL.format("Affero General Public License", "3"),
    "CC-BY-SA-4.0": _CC.format("Attribution-ShareAlike"),
    "CC-BY-ND-4.0": _CC.format("Attribution-NoDerivatives"),
    "CC-BY-NC-4.0-notice": _CC.format("Attribution-NonCommercial"),
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and
        related or neighboring rights to this work.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms
        of the Eclipse Public License 2.0""",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining
        a copy of this software and associated documentation files (the "Software"), to deal in
        the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
        WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
        NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
        IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause-text": _BSD + _AS_IS.format(_HOLDERS),
    "BSD-3-Clause-text": _BSD + _ENDORSE + _AS_IS.format(_HOLDERS),
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice
        and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
        AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
        SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
        FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
        TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "Zlib-text": """This software is provided 'as-is', without any express or implied warranty.
        In no event will the authors be held liable for any damages arising from the use of this
        software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: 1. The origin of this software must not be misrepresented; you
        must not claim that you wrote the original software. If you use this software in a
        product, an acknowledgment in the product documentation would be appreciated but is not
        required. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. 3. This notice may not be removed or
        altered from any source distribution.""",
    "Unlicense-text": """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
        either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    **{f"SPDX {name}": f"SPDX-License-Identifier: {name}" for name in SPDX},
}


def gram_hashes(ids: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash for the n-gram at each place; the largest number if a word of it
    is in no template."""
    n = max(0, len(ids) - gram + 1)
    found, known = np.full(n, 14695981039346656037, np.uint64), np.ones(n, bool)
    for j in range(gram):
        found = (found ^ ids[j:j + n].astype(np.uint64)) * np.uint64(1099511628211)
        found ^= found >> np.uint64(29)
        known &= ids[j:j + n] > 0
    return np.where(known, found, _NONE)


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: of each window the last smallest hash."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    size = min(WINDOW, len(hashes))
    n = len(hashes) - size + 1
    least, place = hashes[:n].copy(), np.arange(n)
    for j in range(1, size):
        lower = hashes[j:j + n] <= least
        least = np.where(lower, hashes[j:j + n], least)
        place = np.where(lower, np.arange(n) + j, place)
    return np.unique(place[least != _NONE])


def fingerprints(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Places of the hashes that are looked up: winnowed, but all of short grams."""
    return winnow(hashes) if gram == GRAM else np.flatnonzero(hashes != _NONE)


class Index:
    """The templates as word numbers, and their fingerprints in order."""

    def __init__(self, templates: dict[str, str]):
        words = {name: words_of(text.encode()) for name, text in sorted(templates.items())}
        if any(len(w) < GRAM for w in words.values()):
            raise ValueError(f"a template has at least {GRAM} words")
        self.vocabulary = {x: n for n, x in enumerate(sorted({x for w in words.values()
                                                              for x in w}), 1)}
        self.names = list(words)
        self.ids = [np.array([self.vocabulary[x] for x in w]) for w in words.values()]
        self.tables = [self._table(gram) for gram in (SHORT_GRAM, GRAM)]

    def _table(self, gram: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """The fingerprints (hash, template, place) of the templates that are
        looked up by grams of this length."""
        entries = sorted((int(hashes[p]), t, p) for t, ids in enumerate(self.ids)
                         if (gram == SHORT_GRAM) == (len(ids) < SHORT)
                         for hashes in [gram_hashes(ids, gram)]
                         for p in fingerprints(hashes, gram).tolist())
        return (gram, np.array([h for h, _, _ in entries], np.uint64),
                *(np.array([e[k] for e in entries], np.int64) for k in (1, 2)))

    def siblings(self, least: float) -> list[set[int]]:
        """Of each template those of like length that a copy of it may pass for."""
        out = [set() for _ in self.ids]
        for a, x in enumerate(self.ids):
            for b, y in enumerate(self.ids[:a]):
                few = min(len(x), len(y))
                if 2 * few >= max(len(x), len(y)) and len(np.intersect1d(x, y)) and align(
                        x, np.concatenate([np.zeros(len(y), np.int64), y]), len(y)
                        )[0] >= least * few:
                    out[a].add(b)
                    out[b].add(a)
        return out

    def band(self, template: int) -> int:
        """Words by which a copy may be out of step."""
        return max(2, len(self.ids[template]) // 5)


def align(template: np.ndarray, part: np.ndarray, band: int) -> tuple[int, int, int]:
    """Most words that the template and a part of a text have in common in
    order, within `band` of the diagonal, and the first and last place of them
    in the part, which begins `band` words before the diagonal."""
    rows = [np.zeros(len(part) + 1, np.int64)]
    for i, word in enumerate(template):
        row = rows[-1].copy()
        low, high = i, min(i + 2 * band + 1, len(part))
        if low < high:
            step = rows[-1][low:high] + (part[low:high] == word)
            row[low + 1:high + 1] = np.maximum(row[low + 1:high + 1], step)
        rows.append(np.maximum.accumulate(row))
    i, j, first, last = len(template), len(part), -1, -1
    while i and j:
        if rows[i][j] == rows[i][j - 1]:
            j -= 1
        elif rows[i][j] == rows[i - 1][j]:
            i -= 1
        else:
            i, j, first = i - 1, j - 1, j - 1
            last = max(last, j)
    return int(rows[-1][-1]), first, last


def _candidates(ids: np.ndarray, begins: np.ndarray, index: Index) -> list[tuple[int, int, int]]:
    """(template, document, diagonal) in a shard, one for each run of diagonals
    within the template's band. The document is that of the fingerprint itself."""
    found = []
    for gram, known, templates, offsets in index.tables:
        hashes = gram_hashes(ids, gram)
        places = fingerprints(hashes, gram)
        low = np.searchsorted(known, hashes[places], "left")
        count = np.searchsorted(known, hashes[places], "right") - low
        entry = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        place = np.repeat(places, count)
        template, diagonal = templates[entry], place - offsets[entry]
        doc = np.searchsorted(begins, place, "right") - 1
        order = np.lexsort((diagonal, doc, template))
        before = None
        for t, x, d in zip(template[order].tolist(), doc[order].tolist(),
                           diagonal[order].tolist(), strict=True):
            if before is None or (t, x) != before[:2] or d - before[2] > index.band(t):
                before = (t, x, d)
                found.append(before)
    return found


def _scan(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = Index(shared.value), {}
        siblings = index.siblings(least)

        def best(spans: set[tuple]) -> list[tuple]:
            """The spans without those that a sibling in the same place fits better."""
            def fit(x: tuple) -> tuple:
                return x[3] / len(index.ids[x[2]]), x[3]
            return sorted(x for x in spans if not any(
                y[2] in siblings[x[2]] and y[0] <= x[1] and x[0] <= y[1] and fit(y) > fit(x)
                for y in spans))

        def shard(rows: list[tuple]) -> pa.RecordBatch:
            sizes = np.array([len(x[2]) for x in rows], np.int64)
            begins = np.cumsum(sizes + GRAM) - sizes - GRAM
            ids = np.zeros(int(begins[-1] + sizes[-1]) + GRAM, np.int64)
            for begin, (_, _, x) in zip(begins, rows, strict=True):
                ids[begin:begin + len(x)] = x
            found = {}
            for t, doc, diagonal in _candidates(ids, begins, index):
                size, band = len(index.ids[t]), index.band(t)
                start = diagonal - band
                low = max(start, int(begins[doc]))
                high = min(diagonal + size + band, int(begins[doc] + sizes[doc]))
                part = np.zeros(max(0, high - start), np.int64)
                part[low - start:] = ids[low:max(low, high)]
                key = (t, part.tobytes())
                if key not in memo:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[key] = align(index.ids[t], part, band)
                matched, first, last = memo[key]
                if matched >= least * size:
                    at = start + first - int(begins[doc])
                    found.setdefault(doc, set()).add(
                        (at, start + last - int(begins[doc]), t, matched))
            out = []
            for doc, spans in sorted(found.items()):
                name, text, _ = rows[doc]
                places = [m.span() for m in _WORD.finditer(text)]
                out += [(name, index.names[t], matched / len(index.ids[t]), matched,
                         places[a][0], places[b][1]) for a, b, t, matched in best(spans)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "license", "coverage", "n_matched", "start", "end"])
        rows, held = [], 0
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                words = words_of(text.encode())
                rows.append((name.as_py(), text, np.fromiter(
                    map(index.vocabulary.get, words, (0 for _ in words)), np.int64, len(words))))
                held += len(words)
                if held >= SHARD_WORDS:
                    yield shard(rows)
                    rows, held = [], 0
        if rows:
            yield shard(rows)
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, license, coverage, n_matched, start, end): each place where
    at least the share `least` of a template's words stands in order in a text;
    start and end are code points, the end exclusive.

    A null or empty text has none; whole texts are scanned. Each row is scanned by
    itself, so repeated rows repeat their matches and null ids are allowed; a
    text may match several templates in one place, but of templates that pass for each
    other (as versions of a header do) only those that fit best. Other columns are not read; an
    empty table gives an empty result. The templates are a short list, checked to
    have at least GRAM words each.
    """
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(dict(TEMPLATES if templates is None else templates))
    Index(shared.value)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(
        _scan(shared, least), "doc_id long, license string, coverage double, n_matched long, "
                              "start long, end long")
