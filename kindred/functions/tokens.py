"""Tokenising for the text rankers, JVM-side expressions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.scalars import SPACE, singular, string_array

# What separates tokens in running English text, found in one pass. Commas and colons
# stay inside numbers (1,000), hyphens and periods inside words (all-purpose, e.g).
# Nearly every character is a letter, so that is ruled out before anything else is tried.
_MARK = rf"{SPACE}|[;@#$%&?!\[\](){{}}<>\"“”«»…]|--|\.\.\.|[:,](?!\p{{Nd}})"
_STOP = rf"\.+['’]*(?={_MARK}|\z)"
_AFTER = rf"(?={_MARK}|{_STOP}|\z)"
_CLITIC = "'(?:s|m|d|ll|re|ve)?" + _AFTER
SEPARATOR = rf"(?:(?![\p{{L}}\p{{N}}])(?:\s+|{_MARK}|{_STOP}|{_CLITIC})|n't{_AFTER})+"

# Letters and digits only, and not digits alone.
WORD = r"^\p{Nd}*[\p{L}\p{Nl}\p{No}][\p{L}\p{N}]*$"


def tokens(text: Column) -> Column:
    """Lower-cased tokens of a text, with repeats."""
    return F.filter(F.split(F.lower(text), SEPARATOR, -1), lambda w: w != "")


def kept_words(text: Column, stop_words: Sequence[str] = K.STOP_WORDS) -> Column:
    """Distinct tokens of letters and digits only: no numbers, no stop words."""
    words = F.split(F.lower(text), SEPARATOR, -1)
    known = F.array_except(words, string_array(stop_words))  # by hash; drops repeats as well
    return F.filter(known, lambda w: F.rlike(w, F.lit(WORD)))


def unique_words(
    text: Column,
    stop_words: Sequence[str] = K.STOP_WORDS,
    exceptions: Mapping[str, str] | None = None,
) -> Column:
    """Sorted set of kept words in singular form."""
    # Distinct first: the suffix rules then run once per word and not per occurrence.
    one = F.transform(kept_words(text, stop_words), lambda w: singular(w, exceptions))
    return F.sort_array(F.array_distinct(one))


def word_terms(text: Column, stop_words: Sequence[str] = K.STOP_WORDS) -> Column:
    """Words of two or more characters in text order, stop words removed."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(*stop_words))


def char_text(text: Column) -> Column:
    """Lower-cased text in which runs of two or more spaces are one blank."""
    return F.regexp_replace(F.lower(text), SPACE + "{2,}", " ")


def word_overlap(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Shared tokens of two rows, summed over the paired fields."""
    return sum(
        (F.size(F.array_intersect(a, b)) for a, b in zip(left, right, strict=True)), F.lit(0)
    )
