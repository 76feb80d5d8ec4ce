import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfline.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "th", "ing", " ", "\n", "'s", "'", "1", "é", "ß", "É", "Σ", "ς", "İ", "́", "한",
         "ᄀ", "ᅡ", "<|endoftext|>", "<|", "²", "º", "\x1c", "\x85", "\xa0", " ", "中", "😀",
         "\xad", "_", "-", ".", "Å", "\x00", "tion", "haha"]


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), encoder.dtype).tolist()


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids_of(bpe.transducer(PATH), text) == want
    assert ids_of(bpe.library_encoder(PATH, "<u2"), text) == want
    decoder = bpe.Decoder(bpe.token_bytes(PATH))
    parts = [decoder.feed(want[i:i + 3]) for i in range(0, len(want), 3)]
    assert "".join(parts) == LIBRARY.decode(want, skip_special_tokens=False)


@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
@settings(max_examples=300, deadline=None)
def test_equals_library(text):
    check(text)


@given(st.text(max_size=40))
@settings(max_examples=300, deadline=None)
def test_equals_library_on_any_text(text):
    check(text)


@given(st.integers(1, 5), st.integers(600, 3000), st.randoms(use_true_random=False))
@settings(max_examples=12, deadline=None)
def test_long_words_are_streamed(letters, size, rng):
    check("".join(rng.choices("aehnt"[:letters], k=size)))


def test_lookahead_is_sufficient():
    """What follows a word's beginning never changes tokens that end before the
    lookahead; the bound is on symbols."""
    merges = bpe.merge_list(PATH)
    assert 0 < merges.lookahead < 1000
    rng = np.random.default_rng(1)
    for _ in range(20):
        word = rng.choice(list(b"aehintr"), 1500).tolist()
        data = [merges.inner[b] for b in word]
        tails = [[merges.inner[b] for b in rng.choice(list(b"aehintr"), 40)] for _ in range(3)]
        sure = []
        for tail in tails:
            ends, kept = 0, []
            for token in merges.merge(data + tail):
                ends += merges.size[token]
                if ends > len(data) - merges.lookahead:
                    break
                kept.append(token)
            sure.append(kept)
        assert sure[0] == sure[1] == sure[2]


def test_query_equals_library(spark):
    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    for r in queries.op5_bpe(spark, root).collect():
        want = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(
            LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_documents(odd_documents, no_documents):
    rows = bpe.digests(bpe.decode(bpe.encode(odd_documents, PATH), PATH)).collect()
    assert len(rows) == odd_documents.count()
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert bpe.encode(no_documents, PATH).count() == 0


def test_both_steps_in_one_worker(odd_documents):
    both = bpe.encode_and_decode(odd_documents, PATH)
    apart = bpe.decode(bpe.encode(odd_documents, PATH), PATH)
    assert sorted(both.collect(), key=str) == sorted(apart.collect(), key=str)
    plan = bpe.digests(both)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_a_word_that_is_its_own_piece_is_remembered_once():
    asked = []
    encoder = bpe.MemoEncoder(lambda data: asked.append(data) or list(data), lambda word: [0])
    text = "ring Ring ring's ring ring-7"
    one = {"ring": b"ring", "Ring": b"ring", "ring's": b"ring's", "ring-7": b"ring-7"}
    expected = [x for word in text.split() for x in one[word]]
    assert list(np.frombuffer(encoder.encode(text), "<u4")) == expected
    assert asked == [b"ring", b"'s", b"-", b"7"]
    kept = [word for memo in vars(encoder).values() if isinstance(memo, dict) for word in memo]
    assert sorted(kept) == sorted({*text.split(), "'s", "-", "7"})
