"""String helpers of the product resolver and the searches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_product_code(identifier: Column) -> Column:
    """True for digits only; null is not a code."""
    return F.coalesce(identifier, F.lit("")).rlike(r"\A[0-9]+\z")


def plain_name(text: Column) -> Column:
    """Lower case, every run of punctuation or blanks made one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def skeleton(text: Column) -> Column:
    """`plain_name` without vowels: what cashiers tend to leave of a name."""
    bare = F.regexp_replace(plain_name(text), "[aeiou]", "")
    return F.trim(F.regexp_replace(bare, " +", " "))


def _packed(three: Column) -> Column:
    """Three letters as one BIGINT, 21 bits each: all a code point needs.
    Arrays of numbers are compared much faster than arrays of strings."""
    letters = [F.ascii(F.substring(three, i, 1)).cast("bigint") for i in (1, 2, 3)]
    return (letters[0] * 2**21 + letters[1]) * 2**21 + letters[2]


def word_trigrams(text: Column) -> Column:
    """Distinct trigrams of the words of `text`, each word marked at both ends,
    as numbers."""
    words = F.filter(F.split(text, " "), lambda w: F.length(w) > 0)
    grams = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w)),
        lambda i: _packed(F.substring(F.concat(F.lit("^"), w, F.lit("$")), i, F.lit(3)))))
    return F.array_distinct(F.flatten(grams))
