"""BPE encoding and decoding as bounded-lookahead streaming transducers.

A text is cut at white space, and its pieces (words, digits, signs) are merged
on their own. Within a piece, however long, a token is final as soon as as many
symbols follow it as the merge list can look ahead; it is emitted then, and
only the symbols behind it are held.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import common

MEMO = 800_000
LONGEST_MEMO = 64
STEP = 512
Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
DECODED = "doc_id long, ids binary, decoded string"

# White space of the pre-tokenizer's pattern; str.split() knows four more signs.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Tokens of ASCII and Latin-1 signs, which normalisation only lower-cases; "<|"
# may begin a special token.
_PLAIN = re.compile("(?!.*<\\|)[\x21-\x7e\xa1-\xac\xae-\xff]+")
_LETTER, _DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves,
    the others for the letters from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def split_words(text: str) -> list[str]:
    return _SPACES.split(text) if _NOT_SPACE.search(text) else text.split()


class MergeList:
    """Merges by the ids of their parts, and the lookahead they need."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        left, made, best = {}, set(), {}
        size = {i: 1 for i in self.vocabulary.values()}
        self.lookahead = 0
        products = {"".join(pair) for pair in model["merges"]}
        for n, (x, y) in enumerate(model["merges"]):
            a, b, c = self.vocabulary[x], self.vocabulary[y], self.vocabulary[x + y]
            if c in made or any(p in products and self.vocabulary[p] not in made for p in (x, y)):
                raise ValueError("a merge list whose tokens are each made once, parts first")
            made.add(c)
            self.rank[a, b] = (n, c)
            left[c], size[c] = a, size[a] + size[b]
            # How far left of unknown input this merge can change a token: the last
            # sure token is `a`, and the one behind it, which merges up to now may have
            # changed, begins with the part that they took in.
            reach, part = 0, b
            while part is not None:
                reach = max(reach, best.get(part, 0))
                part = left.get(part)
            best[a] = max(best.get(a, 0), size[a] + reach)
            self.lookahead = max(self.lookahead, best[a])
        self.size = size
        letters = byte_letters()
        self.inner = [self.vocabulary[x] for x in letters]
        self.final = [self.vocabulary[x + self.suffix] for x in letters]
        self.letter_byte = {x: b for b, x in enumerate(letters)}

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the lowest-ranked pair, leftmost first, until none is left."""
        rank = self.rank
        while len(ids) > 1:
            least, pair, new = 1 << 62, None, 0
            for x in zip(ids, ids[1:]):  # noqa: B905
                if (found := rank.get(x)) is not None and found[0] < least:
                    least, new, pair = found[0], found[1], x
            if pair is None:
                break
            a, b = pair
            out, i, n = [], 0, len(ids)
            while i < n:
                if ids[i] == a and i + 1 < n and ids[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stream(self, data: bytes) -> Iterator[int]:
        """Tokens of one piece, emitted once no following symbol can change
        them; at most lookahead + STEP symbols are held."""
        held: list[int] = []
        for start in range(0, len(data) - 1, STEP):
            held += [self.inner[b] for b in data[start:min(start + STEP, len(data) - 1)]]
            if len(held) > self.lookahead + 1:
                end = 0
                for token in self.merge(held):
                    if end + self.size[token] > len(held) - self.lookahead:
                        break
                    end += self.size[token]
                    yield token
                held = held[end:]
        yield from self.merge(held + [self.final[data[-1]]])


class MemoEncoder:
    """Encodes a text word by word, remembering a bounded number of words and pieces
    together, since a piece is a word with the same ids. `piece` gives the ids of a lower-cased piece, `other` those of a word with
    signs beyond Latin-1 or with a special token."""

    def __init__(self, piece: Callable[[bytes], list[int]], other: Callable[[str], list[int]],
                 dtype: str = "<u4"):
        self.piece, self.other, self.dtype = piece, other, dtype
        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        self.words: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _remember(self, word: str, found: bytes) -> bytes:
        if len(word) <= LONGEST_MEMO:
            if len(self.words) >= MEMO:
                self.words.clear()
            self.words[word] = found
        return found

    def _piece(self, piece: str) -> bytes:
        if (found := self.words.get(piece)) is None:
            found = self._remember(piece, self._packed(self.piece(piece.encode())))
        return found

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            return self._remember(word, self._packed(self.other(word)))
        pieces = _PIECES.findall(word.lower())
        if len(pieces) == 1:
            found = self._piece(pieces[0])
            return found if pieces[0] == word else self._remember(word, found)
        return self._remember(word, b"".join(map(self._piece, pieces)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian integers; none for a null."""
        words = split_words(text or "")
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if x is None else x
                     for w, x in zip(words, found, strict=True)]
        return b"".join(found)


@functools.cache
def merge_list(path: str) -> MergeList:
    return MergeList(path)


@functools.cache
def transducer(path: str) -> MemoEncoder:
    """The streaming encoder of a tokenizer file, one per worker."""
    merges, library = merge_list(path), Tokenizer.from_file(path)
    special = re.compile("(" + "|".join(map(re.escape, merges.special)) + ")"
                         if merges.special else "(?!)")

    def piece(data: bytes) -> list[int]:
        return list(merges.stream(data))

    def other(word: str) -> list[int]:
        ids = []
        for part in special.split(word):
            if part in merges.special:
                ids.append(merges.special[part])
            else:
                for x, _ in library.pre_tokenizer.pre_tokenize_str(
                        library.normalizer.normalize_str(part)):
                    ids += piece(bytes([merges.letter_byte[c] for c in x]))
        return ids
    return MemoEncoder(piece, other)


@functools.cache
def library_encoder(path: str, dtype: str) -> MemoEncoder:
    """The tokenizers library, asked once for a word that is remembered."""
    library, letters = Tokenizer.from_file(path), byte_letters()

    def piece(data: bytes) -> list[int]:
        # Pieces have printable ASCII only, which stands for itself.
        text = data.decode() if data.isascii() else "".join([letters[b] for b in data])
        return [x.id for x in library.model.tokenize(text)]

    def other(word: str) -> list[int]:
        return library.encode(word, add_special_tokens=False).ids
    return MemoEncoder(piece, other, dtype)


class Decoder:
    """From ids to text, a few at a time: the bytes of the tokens, set apart by
    a space where the tokenizer has no decoder, through a UTF-8 state machine
    that holds the bytes of an unfinished character."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.gap = tokens, b""
        self.text = codecs.getincrementaldecoder("utf-8")()

    def feed(self, ids: list[int]) -> str:
        known = [x for x in map(self.tokens.get, ids) if x is not None]
        if not known:
            return ""
        data, self.gap = self.gap + b" ".join(known), b" "
        return self.text.decode(data)


@functools.cache
def token_bytes(path: str) -> dict[int, bytes]:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if spec["decoder"] is not None:
        raise ValueError("a tokenizer file without a decoder")
    return ({i: x.encode() for x, i in spec["model"]["vocab"].items()}
            | {x["id"]: x["content"].encode() for x in spec["added_tokens"]})


def encode(docs: DataFrame, path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids) for each row of `docs`: the ids of the whole text as
    little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Each row is encoded by itself, so repeated
    rows, ties and null ids need no rule; other columns are not read.
    """
    return _texts(docs, id_col, text_col).mapInArrow(_encoding(path), "doc_id long, ids binary")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    common.prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _encoding(path: str) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = transducer(path)
        for batch in batches:
            ids = [encoder.encode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    return run


def decode(encoded: DataFrame, path: str, step: int = 1 << 16) -> DataFrame:
    """Adds `decoded`, the text of the column `ids`, to rows (doc_id, ids). No
    ids give an empty text; ids without a token are passed over."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoding(path, step), DECODED)


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id",
                      text_col: str = "text", step: int = 1 << 16) -> DataFrame:
    """`decode` of `encode`, batch after batch in the same workers: a task has one
    worker instead of two, and the ids pass between them once less."""
    encoding, decoding = _encoding(path), _decoding(path, step)
    return _texts(docs, id_col, text_col).mapInArrow(
        lambda batches: decoding(encoding(batches)), DECODED)


def _decoding(path: str, step: int) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(path)
        for batch in batches:
            texts = []
            for x in batch.column(1):
                ids, decoder = np.frombuffer(x.as_py(), "<u4"), Decoder(tokens)
                texts.append("".join([decoder.feed(ids[i:i + step].tolist())
                                      for i in range(0, len(ids), step)]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
    return run


def digests(decoded: DataFrame) -> DataFrame:
    """Of rows (doc_id, ids, decoded): doc_id, n_tokens and both SHA-256."""
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
