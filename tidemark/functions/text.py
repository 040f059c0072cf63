"""Cleaning and splitting of text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

# What cleaning removes (everything but letters, digits and white space, so the
# underscore too) and the extra stop word.
STRIPPED = r"(?U)[^\s\p{L}\p{N}\x1c-\x1f]+"
EXTRA_STOP_WORD = "say"

# Languages whose stop lists ship with Spark.
STOP_LANGUAGES = [
    "danish", "dutch", "english", "finnish", "french", "german", "hungarian", "italian",
    "norwegian", "portuguese", "russian", "spanish", "swedish", "turkish",
]


def default_stop_words(languages: Iterable[str] = tuple(STOP_LANGUAGES)) -> list[str]:
    """Spark's stop words of the given languages and the extra one; needs a running session.

    Lists of several languages also remove content words ("war" and "die" are German stop words),
    so pass only the languages that are wanted.
    """
    words = {EXTRA_STOP_WORD}
    for language in languages:
        words.update(StopWordsRemover.loadDefaultStopWords(language))
    return sorted(words)


def default_profiles(languages: Iterable[str] = tuple(STOP_LANGUAGES)) -> dict[str, list[str]]:
    """Stop words per language, for telling languages apart; needs a running session."""
    return {language: sorted(StopWordsRemover.loadDefaultStopWords(language)) for language in languages}


def stripped(text: Column) -> Column:
    """Lower-cased text without punctuation and underscores."""
    return F.lower(F.regexp_replace(text, STRIPPED, ""))


def tokens(text: Column) -> Column:
    """Cleaned text split on single spaces; double spaces leave empty tokens."""
    return F.split(stripped(text), " ")


def without_words(words: Column, stop_words: Iterable[str]) -> Column:
    """Every occurrence of a stop word removed; repeats and order of the rest are kept."""
    stops = sorted(set(stop_words))
    return F.filter(words, lambda w: ~w.isin(stops)) if stops else words


def rejoined(words: Column) -> Column:
    return F.array_join(words, " ")


def first_of_pair(pair: Column) -> Column:
    """First element of an array, null when it is missing."""
    return F.get(pair, F.lit(0))


def second_of_pair(pair: Column) -> Column:
    return F.get(pair, F.lit(1))
