"""From raw headlines to cleaned, scored rows and a daily sentiment series."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import scoring, text as tx
from tidemark.functions.dates import epoch_to_iso
from tidemark.operators.lexicon import lexicon_score, prepared
from tidemark.operators.rows import computed, require_non_empty, require_non_null
from tidemark.operators.scaling import group_mean, min_max
from tidemark.operators.topk import TOP_SCORES, keep_top_distinct, top_distinct_mean
from tidemark.schemas import REQUIRED_RAW_FIELDS
from tidemark.session import staged

LANGUAGE = "english"
# Names of the daily series.
ALL_NEWS, TOP_NEWS = "avg_sentiment_all_news", "avg_sentiment_top_news"


def clean_headlines(
    raw: DataFrame,
    stop_words: Sequence[str],
    profiles: Mapping[str, Iterable[str]],
    valences: Mapping[str, float],
    weights: Mapping[str, float],
    language: str = LANGUAGE,
) -> DataFrame:
    """Complete headlines in one language, cleaned, dated and scored; raw columns are kept.

    One narrow pass: nothing is shuffled and no row leaves the JVM. The language is judged on all tokens,
    since the words that tell languages apart are the stop words removed afterwards.
    """
    if language not in profiles:
        raise ValueError(f"no profile for {language}; there are {sorted(profiles)}")
    words = F.col("_words")

    def read(tokens: Column) -> Column:
        spoken = scoring.likely_language(tokens, profiles).alias("_language")
        return F.struct(spoken, tokens.alias("_words"))

    # Filters are not pushed below a generator, so the text is split once and not again in each filter.
    complete = require_non_null(raw, REQUIRED_RAW_FIELDS)
    spoken = complete.select("*", F.inline(F.transform(F.array(tx.tokens(F.col("title"))), read))).where(
        F.col("_language") == language
    )
    kept = computed(spoken, tx.without_words(words, stop_words), "_words")
    titled = computed(kept, tx.rejoined(words), "title_clean")
    hits = scoring.only_words(words, [*valences, *weights])
    return (
        require_non_empty(titled, "title_clean", ["url", "domain"])
        .withColumn("_words", hits)
        .withColumns(
            {
                "created_utc_iso": epoch_to_iso(F.col("created_utc")),
                "polarity": scoring.polarity(words, valences),
                "subjectivity": scoring.subjectivity(words, weights),
            }
        )
        .drop("_words", "_language")
    )


def clean_headlines_by_table(
    raw: DataFrame, stop_words: Sequence[str], profiles: Mapping[str, Iterable[str]], lexicon: DataFrame, language: str = LANGUAGE
) -> DataFrame:
    """:func:`clean_headlines` with a word table of any size: ``word, valence, subjectivity``.

    The cleaned rows are staged with a number each, scored by joins and given their scores by that number.
    """
    plain = clean_headlines(raw, stop_words, profiles, {}, {}, language).drop("polarity", "subjectivity")
    rows = staged(plain.withColumn("_row", F.monotonically_increasing_id()), "cleaned")
    words = rows.select("_row", F.split("title_clean", " ").alias("_words"))
    for value, mode, out in (("valence", "compound", "polarity"), ("subjectivity", "mean", "subjectivity")):
        rows = rows.join(lexicon_score(words, "_row", "_words", prepared(lexicon, value), value, mode, out), "_row")
    return rows.drop("_row")


def clean_rows(cleaned: DataFrame) -> DataFrame:
    """The columns later jobs read, in the layout of ``CLEAN_HEADLINE``."""
    return cleaned.select(
        "title_clean",
        "title",
        F.col("created_utc_iso").cast("date").alias("created_utc_iso"),
        "polarity",
        "subjectivity",
        F.col("score").cast("bigint").alias("score"),
        F.col("num_comments").cast("bigint").alias("num_comments"),
    )


def daily_sentiment(
    cleaned: DataFrame,
    day: str = "created_utc_iso",
    score: str = "score",
    value: str = "polarity",
    k: int = TOP_SCORES,
) -> DataFrame:
    """Mean value per day over the day's best-scored rows, and the mean scaled to [0, 1] over all days:
    ``day, avg_sentiment, normalized_avg``.

    The means, one row per day, are staged before they are scaled: whatever made ``cleaned`` runs once.
    """
    means = top_distinct_mean(cleaned, day, score, value, "avg_sentiment", k)
    return min_max(staged(means, "daily"), "avg_sentiment", "normalized_avg")


def daily_series_of_news(cleaned: DataFrame, day: str = "created_utc_iso", score: str = "score", value: str = "polarity") -> DataFrame:
    """Both daily series: ``day, avg_sentiment_all_news, avg_sentiment_top_news``.

    The first is the mean over all rows of a day, the second that over its best-scored rows, each scaled to [0, 1]
    over all days. A day whose rows all lack a score has no second value.
    """
    every = group_mean(cleaned, day, value, ALL_NEWS)
    best = top_distinct_mean(cleaned, day, score, value, TOP_NEWS)
    both = staged(every.join(best, day, "left"), "daily")
    return min_max(min_max(both, ALL_NEWS, ALL_NEWS), TOP_NEWS, TOP_NEWS)


def daily_sentiment_from_rows(
    cleaned: DataFrame,
    day: str = "created_utc_iso",
    score: str = "score",
    value: str = "polarity",
    k: int = TOP_SCORES,
) -> DataFrame:
    """The same series by way of the kept rows, for when the rows are wanted as well."""
    top = keep_top_distinct(cleaned, day, score, k)
    means = group_mean(top, day, value, "avg_sentiment")
    return min_max(staged(means, "daily"), "avg_sentiment", "normalized_avg")
