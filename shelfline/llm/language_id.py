"""Language identification by a linear-chain conditional random field.

Words are labelled by forward-backward, so a text may change its language in
the middle; a document gets the language with the most expected words. Features
of a word: its affixes, its inner letter n-grams and a learned lexicon.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import common

UNDETERMINED = "und"
BUCKETS = 1 << 16
MEMO = 300_000
# Words labelled in one go, unless one text has more.
CHUNK_WORDS = 1 << 20
RUNS = "array<struct<lang:string,first:bigint,n_words:bigint>>"

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Sample:
    """Bounds of the rows a model is fitted on."""
    docs_per_language: int = 400
    words_per_doc: int = 250
    sequences: int = 2000
    sequence_words: int = 120
    segment_words: int = 30
    iterations: int = 40


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language
    transitions: np.ndarray  # from x to
    lexicon: dict[str, int] = field(default_factory=dict)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Buckets of a word's features."""
    marked = f"<{word}>"
    found = [f"p{word[:n]}" for n in (1, 2, 3)] + [f"s{word[-n:]}" for n in (1, 2, 3, 4)]
    found += [marked[i:i + n] for n in (2, 3) for i in range(len(marked) - n + 1)]
    if (language := lexicon.get(word)) is not None:
        found.append(f"lexicon={language}")
    return [zlib.crc32(x.encode()) % BUCKETS for x in found]


def _emissions(words: list[str], weights: np.ndarray, lexicon: dict[str, int]):
    """Label scores of each word, and the buckets they were summed from."""
    lists = [features(w, lexicon) for w in words]
    sizes = np.array([len(x) for x in lists])
    flat = np.array([b for x in lists for b in x], np.int32)
    begins = np.cumsum(sizes) - sizes
    scores = (np.add.reduceat(weights[flat], begins, axis=0) if len(words)
              else np.zeros((0, weights.shape[1])))
    return scores, flat, sizes


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray):
    """Posterior label probabilities of sequences laid end to end, and the
    expected number of each transition. All sequences advance together, the
    longest first, one place a step."""
    labels = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # sequences longer than t
    at = np.concatenate(([0], np.cumsum(live))).astype(np.int64)
    begins = (np.cumsum(lengths) - lengths)[order]
    place = np.concatenate([begins[:n] + t for t, n in enumerate(live)]) if longest else \
        np.zeros(0, np.int64)
    potential = scores[place]
    potential = np.exp(potential - potential.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    alpha = np.empty_like(potential)
    for t in range(longest):
        a = potential[at[t]:at[t + 1]]
        if t:
            a = a * (alpha[at[t - 1]:at[t - 1] + live[t]] @ step)
        alpha[at[t]:at[t + 1]] = a / a.sum(axis=1, keepdims=True)
    expected = np.zeros((labels, labels))
    beta = np.ones((0, labels))
    post = np.empty_like(alpha)
    for t in range(longest - 1, -1, -1):
        new = np.ones((live[t], labels), potential.dtype)
        if len(beta):
            ahead = potential[at[t + 1]:at[t + 2]] * beta
            # Pair probabilities of this place and the next.
            now = alpha[at[t]:at[t] + len(beta)]
            back = ahead @ step.T
            scale = (now * back).sum(axis=1, keepdims=True)
            expected += (now / scale).T @ ahead * step
            new[:len(beta)] = back / back.sum(axis=1, keepdims=True)
        beta = new
        p = alpha[at[t]:at[t + 1]] * beta
        post[at[t]:at[t + 1]] = p / p.sum(axis=1, keepdims=True)
    out = np.empty_like(post)
    out[place] = post
    return out, expected


def train(segments: list[tuple[str, list[str]]], sample: Sample) -> Model:
    """Fit the field to (language, words) segments. The training sequences
    change the language after `segment_words` words on average, so that
    transitions can be learned from documents with one label each; the lexicon
    comes from other segments than the sequences."""
    languages = sorted({lang for lang, _ in segments})
    number = {x: i for i, x in enumerate(languages)}
    weights = np.zeros((BUCKETS, len(languages)))
    transitions = np.zeros((len(languages), len(languages)))
    if len(languages) < 2:
        return Model(languages, weights.astype(np.float32), transitions)
    rng = np.random.default_rng(0)
    counts: dict[str, Counter] = {}
    for lang, words in segments[::2]:
        for w in words:
            counts.setdefault(w, Counter())[lang] += 1
    lexicon = {w: number[c.most_common(1)[0][0]] for w, c in counts.items()
               if c.total() >= 3 and c.most_common(1)[0][1] >= 0.9 * c.total()}
    pool: dict[int, list[list[str]]] = {}
    for lang, words in segments[1::2] or segments:
        pool.setdefault(number[lang], []).append(words)
    known = sorted(pool)
    sequences, gold = [], []
    for _ in range(sample.sequences):
        words, marks = [], []
        while len(words) < sample.sequence_words:
            lang = known[rng.integers(len(known))]
            source = pool[lang][rng.integers(len(pool[lang]))]
            size = int(rng.geometric(1 / sample.segment_words))
            start = int(rng.integers(max(1, len(source) - size)))
            piece = source[start:start + size]
            words += piece or ["a"]
            marks += [lang] * max(1, len(piece))
        sequences += words
        gold.append(np.array(marks))
    lengths = np.array([len(x) for x in gold])
    gold = np.concatenate(gold)
    types, which = np.unique(np.array(sequences, object).astype(str), return_inverse=True)
    _, flat, sizes = _emissions(list(types), weights, lexicon)
    owner = np.repeat(np.arange(len(types)), sizes)
    begins = np.cumsum(sizes) - sizes
    total, labels = len(gold), len(languages)
    inside = np.ones(total, bool)
    inside[np.cumsum(lengths)[:-1]] = False
    inside[0] = False
    seen = np.zeros_like(transitions)
    np.add.at(seen, (gold[:-1][inside[1:]], gold[1:][inside[1:]]), 1)
    moment = [np.zeros_like(weights), np.zeros_like(transitions)]
    speed = [np.zeros_like(weights), np.zeros_like(transitions)]
    for n in range(1, sample.iterations + 1):
        emitted = np.add.reduceat(weights[flat], begins, axis=0)
        post, expected = forward_backward(emitted[which], lengths, transitions)
        post[np.arange(total), gold] -= 1
        by_type = np.stack([np.bincount(which, post[:, k], len(types)) for k in range(labels)], 1)
        slope = np.stack([np.bincount(flat, by_type[owner, k], BUCKETS)
                          for k in range(labels)], 1) / total + 1e-6 * weights
        for i, (value, g) in enumerate(((weights, slope),
                                        (transitions, (expected - seen) / total))):
            moment[i] = 0.9 * moment[i] + 0.1 * g
            speed[i] = 0.99 * speed[i] + 0.01 * g * g
            value -= 0.1 * (moment[i] / (1 - 0.9 ** n)) / (
                np.sqrt(speed[i] / (1 - 0.99 ** n)) + 1e-8)
    return Model(languages, weights.astype(np.float32), transitions, lexicon)


class Labeller:
    """Labels words by a model, remembering the scores of a bounded number."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def _learn(self, words: list[str]) -> None:
        """Scores of new words; a word without a letter gets row -1."""
        if len(self.rows) > MEMO:
            self.rows, self.scores = {}, self.scores[:0]
        new = []
        for w in dict.fromkeys(words):
            if w not in self.rows:
                if any(map(str.isalpha, w)):
                    self.rows[w] = len(self.scores) + len(new)
                    new.append(w)
                else:
                    self.rows[w] = -1
        if new:
            scores, _, _ = _emissions(new, self.model.weights, self.model.lexicon)
            self.scores = np.concatenate((self.scores, scores.astype(np.float32)))

    def label(self, texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Of each list of words: the label of each, -1 without a letter, and
        the expected words of each language."""
        flat = [w for words in texts for w in words]
        lengths = np.array([len(x) for x in texts], np.int64)
        if len(flat) - sum(map(self.rows.__contains__, flat)):
            self._learn(flat)
            if not all(map(self.rows.__contains__, flat)):
                self._learn(flat)
        row = np.fromiter(map(self.rows.__getitem__, flat), np.int64, len(flat))
        letters = row >= 0
        text = np.repeat(np.arange(len(texts)), lengths)
        sizes = np.bincount(text[letters], minlength=len(texts))
        post, _ = forward_backward(self.scores[row[letters]], sizes,
                                   self.model.transitions.astype(np.float32))
        labels = np.full(len(flat), -1, np.int64)
        if len(post):
            labels[letters] = post.argmax(axis=1)
        mass = np.stack([np.bincount(text[letters], post[:, k], len(texts))
                         for k in range(post.shape[1])], 1) if post.shape[1] else \
            np.zeros((len(texts), 0))
        return np.split(labels, np.cumsum(lengths)[:-1]), mass


def held_out(id_col: str) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from a sample of about `docs_per_language` documents of each
    language that are not held out, drawn by a hash of the id; of a long one,
    `words_per_doc` words in a row from a place that the hash chooses. Rows with
    a null in one of the three columns are not learned from."""
    common.prepare(docs.sparkSession)
    rows = docs.where(~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text")).dropna()
    # One row for each language.
    rates = rows.groupBy("lang").count().select(
        F.col("lang").alias("of"),
        (F.lit(sample.docs_per_language) / F.col("count")).alias("rate"))
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = rows.join(F.broadcast(rates), F.col("lang") == F.col("of")).where(
        draw < F.col("rate")).select("id", "lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, texts = (c.to_pylist() for c in batch.columns)
            pieces = []
            for i, text in zip(ids, texts, strict=True):
                words = [w for w in words_of(text) if any(map(str.isalpha, w))]
                room = max(0, len(words) - sample.words_per_doc)
                start = zlib.crc32(str(i).encode()) % (room + 1)
                pieces.append([w[:64] for w in words[start:start + sample.words_per_doc]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(langs), pa.array(pieces, pa.list_(pa.string()))],
                names=["id", "lang", "words"])
    found = drawn.mapInArrow(cut, "id long, lang string, words array<string>").where(
        "size(words) > 0").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r.id).encode()), r.id, r.lang))
    return train([(r.lang, r.words) for r in found], sample)


def label(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text",
          with_runs: bool = True) -> DataFrame:
    """For each row of `docs`: `row` (a struct of the columns `keep`),
    lang_pred, score (the share of the expected words that is in that language)
    and `runs`, the stretches of words of one language (lang, first, n_words).

    A text that is null or has no letter is "und" with score 0 and no runs, and
    so is every text if no language was learned; equal shares go to the first
    language in alphabetical order. Whole texts are labelled, each by itself, so
    repeated rows give equal results. Only the named columns are read.
    """
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, " \
             f"score double, runs {RUNS}"
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()),
                               ("n_words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        names = labeller.model.languages

        def runs_of(labels: np.ndarray) -> list[dict]:
            if not with_runs or not len(labels):
                return []
            begin = np.flatnonzero(np.concatenate(([True], labels[1:] != labels[:-1])))
            size = np.diff(np.append(begin, len(labels)))
            return [{"lang": names[k], "first": b, "n_words": n} for k, b, n in
                    zip(labels[begin].tolist(), begin.tolist(), size.tolist(), strict=True)
                    if k >= 0]

        def finish(parts: list, texts: list[list[str]]) -> pa.RecordBatch:
            if names:
                labels, mass = labeller.label(texts)
            else:
                labels, mass = [np.zeros(0, int)] * len(texts), np.zeros((len(texts), 1))
            total = mass.sum(axis=1)
            best = mass.argmax(axis=1)
            some = total > 0
            score = np.where(some, mass[np.arange(len(texts)), best] / np.where(some, total, 1), 0)
            predicted = [names[k] if ok else UNDETERMINED
                         for k, ok in zip(best.tolist(), some.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(parts), pa.array(predicted, pa.string()),
                 pa.array(np.clip(score, 0, 1)), pa.array(map(runs_of, labels), kind)],
                names=["row", "lang_pred", "score", "runs"])
        parts, texts, held = [], [], 0
        for batch in batches:
            at = 0
            for i, text in enumerate(batch.column(1)):
                texts.append(words_of(text.as_py()))
                held += len(texts[-1])
                if held >= CHUNK_WORDS:
                    parts.append(batch.column(0).slice(at, i + 1 - at))
                    yield finish(parts, texts)
                    parts, texts, held, at = [], [], 0, i + 1
            if at < batch.num_rows:
                parts.append(batch.column(0).slice(at))
        if texts:
            yield finish(parts, texts)
    return rows.mapInArrow(run, schema)


def drop_rejected(docs: DataFrame, least: float = 0.34, sample: Sample = Sample()) -> DataFrame:
    """`docs` without the texts that have no letter, and those of which no
    language has `least` of the words."""
    found = label(docs, fit(docs, sample), docs.columns, with_runs=False)
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)
                       ).select("row.*")
