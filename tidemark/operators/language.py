"""Languages told apart by their character n-grams, learnt from texts of known language."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.lexicon import BROADCAST_ROWS
from tidemark.session import staged

SIZE = 3
UNIT = 1000  # log-probabilities are whole numbers of 1/UNIT, so sums don't depend on their order


def ngrams(words: Column, size: int = SIZE) -> Column:
    """All runs of ``size`` characters of the words, each with a space before and after it."""

    def of(word: Column) -> Column:
        framed = F.concat(F.lit(" "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(framed) - (size - 1), F.lit(1))), lambda i: F.substring(framed, i, size))

    return F.flatten(F.transform(F.filter(words, lambda w: w.isNotNull() & (w != "")), of))


def learn(df: DataFrame, tokens: str, lang: str, min_count: int = 3, size: int = SIZE) -> tuple[list[str], DataFrame]:
    """The languages, and ``gram, weights`` with a weight of each gram for each of them, in their order by name.

    A weight is the logarithm of the gram's share among its language's grams, one being added to every count. Grams that
    occur fewer than ``min_count`` times in all are left out.
    """
    rows = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode_outer(ngrams(F.col(tokens), size)).alias("gram"))
    counted = staged(rows.where(F.col("gram").isNotNull()).groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("n")), "grams")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # one row per language
    langs = sorted(totals)
    kept = counted.groupBy("gram").agg(F.sum("n").alias("all"), *[F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, x in enumerate(langs)])
    kept = staged(kept.where(F.col("all") >= min_count), "grams")
    kinds = kept.count()
    weights = [F.round(F.ln((F.col(f"n{k}") + 1) / F.lit(float(totals[x] + kinds))) * UNIT).cast("bigint") for k, x in enumerate(langs)]
    return langs, staged(kept.select("gram", F.array(*weights).alias("weights")), "profiles")


def most_likely(df: DataFrame, id_col: str, tokens: str, langs: Sequence[str], profiles: DataFrame, size: int = SIZE) -> DataFrame:
    """``id, lang``: the language under which a row's known grams are likeliest, the first by name on a tie.

    A row without any known gram is left out. Profiles up to a counted bound go to every task, where a row's weights are
    added up before the one shuffle by id; larger ones are joined by gram.
    """
    table = F.broadcast(profiles) if profiles.count() <= BROADCAST_ROWS else profiles
    grams = df.select(id_col, F.explode_outer(ngrams(F.col(tokens), size)).alias("gram"))
    sums = [F.sum(F.get("weights", F.lit(k))).alias(f"s{k}") for k in range(len(langs))]
    scored = grams.join(table, "gram").groupBy(id_col).agg(*sums)
    best = F.array_max(F.array(*[F.struct(F.col(f"s{k}").alias("score"), F.lit(-k).alias("place"), F.lit(x).alias("lang")) for k, x in enumerate(langs)]))
    return scored.select(id_col, best["lang"].alias("lang"))
