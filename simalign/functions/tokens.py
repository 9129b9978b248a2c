"""Tokenisers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is two or more letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Characters the index tokeniser turns into spaces (the apostrophe stays).
INDEX_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def _non_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def whitespace_tokens(text: Column) -> Column:
    """Split on runs of whitespace, case kept."""
    return _non_empty(F.split(text, r"\s+"))


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def index_tokens(text: Column) -> Column:
    """Lower-cased, punctuation to spaces, split on spaces."""
    spaced = F.translate(F.lower(text), INDEX_FILTERS, " " * len(INDEX_FILTERS))
    return _non_empty(F.split(spaced, " "))


def space_tokens(text: Column) -> Column:
    """Split on every single space; neighbours give empty tokens."""
    return F.split(text, " ")


def normalise(text: Column, stop_words: list[str]) -> Column:
    """Lower-case, keep letters only, drop stop words, join by one space."""
    letters = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), " ")
    kept = F.filter(letters, lambda t: (t != "") & ~t.isin(stop_words))
    return F.array_join(kept, " ")


def fill_text(text: Column) -> Column:
    """A missing text becomes one space, which holds no token."""
    return F.coalesce(text, F.lit(" "))
