"""Tokenisation column builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry.functions.scalars import WHITESPACE

# Two or more word characters: letters, numbers and underscore of any script.
TERM = r"[\p{L}\p{N}_]{2,}"


def split_words(text: Column) -> Column:
    """Whitespace tokens with punctuation kept; blank text gives an empty array."""
    return F.filter(F.split(text, f"{WHITESPACE}+"), lambda w: w != "")


def terms(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case terms without stop words, null text giving an empty array."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)
    if not stop_words:
        return found
    return F.filter(found, lambda w: ~w.isin(list(stop_words)))


def phrases(words: Column, max_n: int = 2) -> Column:
    """2..max_n-grams over a term array *column*; a null word breaks every phrase it would be part of."""
    grown, out = words, []
    for n in range(2, max_n + 1):
        grown = F.zip_with(grown, F.slice(words, n, F.size(words)), lambda left, word: F.concat(left, F.lit(" "), word))
        out.append(F.filter(grown, lambda p: p.isNotNull()))
    return F.concat(*out) if out else F.array().cast("array<string>")


def ngram_terms(kept: Column, max_n: int = 2) -> Column:
    """1..max_n-grams over a term array *column* (formed after stop-word removal)."""
    return F.concat(kept, phrases(kept, max_n))
