"""Lexicon scores and language votes of a token array.

These forms take a word table that sits in the program, so a row is scored where it is: no shuffle, no
state. Tables of any size go through :mod:`tidemark.operators.lexicon` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from zlib import crc32

from pyspark.sql import Column, functions as F

# Normalisation constant of the compound score and width of the neutral band.
COMPOUND_ALPHA = 15.0
NEUTRAL_BAND = 0.05

MAP_SIZE = 8


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Catalyst copies a computed column into every use of it when it pushes a filter down; a lambda variable
    is not copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compound(total: Column) -> Column:
    """Sum of valences squeezed into [-1, 1]."""
    return total / F.sqrt(total * total + F.lit(COMPOUND_ALPHA))


def known_values(words: Column, table: Mapping[str, float]) -> Column:
    """Values of the tokens that are in the table, in token order.

    A hash-set test drops nearly all tokens first. Map lookup is linear, so the table is cut into small
    maps by checksum and each hit is looked up in one of them.
    """
    keys = sorted(table)
    slots = max(1, len(keys) // MAP_SIZE)
    maps: list[dict[str, float]] = [{} for _ in range(slots)]
    for key in keys:
        maps[crc32(key.encode()) % slots][key] = float(table[key])

    def lookup(word: Column) -> Column:
        slot = (F.crc32(word.cast("binary")) % slots).cast("int")
        return F.try_element_at(F.get(values, slot), word)

    values = F.array(
        *[F.map_from_arrays(_strings(list(m)), _doubles(list(m.values()))) for m in maps]
    )
    return F.transform(only_words(words, keys), lookup)


def only_words(words: Column, known: Iterable[str]) -> Column:
    """The tokens that are in ``known``, in order."""
    keys = sorted(set(known))
    return F.filter(words, lambda w: w.isin(keys))


def _strings(values: list[str]) -> Column:
    return F.lit(values) if values else F.array().cast("array<string>")


def _doubles(values: list[float]) -> Column:
    return F.lit(values) if values else F.array().cast("array<double>")


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def polarity(words: Column, valences: Mapping[str, float]) -> Column:
    """Compound polarity in [-1, 1]; 0 when no token is known."""
    return bound(array_sum(known_values(words, valences)), compound)


def subjectivity(words: Column, weights: Mapping[str, float]) -> Column:
    """Mean weight of the known tokens; 0 when there is none."""
    def mean(values: Column) -> Column:
        return F.coalesce(F.try_divide(array_sum(values), F.size(values)), F.lit(0.0))

    return F.when(words.isNotNull(), bound(known_values(words, weights), mean))


def polarity_label(score: Column, band: float = NEUTRAL_BAND) -> Column:
    """2 above the neutral band, 0 below it, 1 inside; NaN counts as neutral, null stays null."""
    value = score.cast("double")
    return (
        F.when(value.isNull(), None)
        .when(F.isnan(value), 1.0)
        .when(value > band, 2.0)
        .when(value < -band, 0.0)
        .otherwise(1.0)
    )


def likely_language(words: Column, profiles: Mapping[str, Iterable[str]]) -> Column:
    """Language with the most stop words among the tokens, first by name on a tie, null without any."""

    def vote(tokens: Column) -> Column:
        votes = [
            F.struct(
                F.size(only_words(tokens, profiles[lang])).alias("hits"),
                F.lit(-place).alias("place"),
                F.lit(lang).alias("lang"),
            )
            for place, lang in enumerate(sorted(profiles))
        ]
        return F.array_max(F.array(*votes))

    telling = only_words(words, {w for lang in profiles for w in profiles[lang]})
    return bound(bound(telling, vote), lambda best: F.when(best["hits"] > 0, best["lang"]))
