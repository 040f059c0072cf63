"""Word counts, joined titles and inverse document frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.topk import top_words
from tidemark.session import join_per_key, staged

# Words left out of the yearly word pictures besides the English stop words.
PICTURE_STOP_WORDS = [
    "new", "world", "says", "say", "year", "video", "day", "may", "make", "top", "amp", "report",
    "two", "best", "home", "government", "online", "time",
]


def distinct_titles(df: DataFrame, group: str, text: str) -> DataFrame:
    """Each text once per group. The shuffle key holds the text, so a large group is spread out and
    copies of one text collapse in each task before it."""
    return df.where(F.col(group).isNotNull() & F.col(text).isNotNull()).select(group, text).distinct()


def word_counts(
    df: DataFrame, group: str, text: str, stop_words: Sequence[str] = PICTURE_STOP_WORDS
) -> DataFrame:
    """How often each word occurs in the group's distinct texts: ``group, word, n``."""
    words = distinct_titles(df, group, text).select(group, F.explode_outer(F.split(text, " ")).alias("word"))
    kept = words.where((F.col("word") != "") & ~F.col("word").isin(sorted(set(stop_words))))
    return kept.groupBy(group, "word").agg(F.count(F.lit(1)).alias("n"))


def word_freq(
    df: DataFrame,
    group: str,
    text: str,
    k: int,
    stop_words: Sequence[str] = PICTURE_STOP_WORDS,
) -> DataFrame:
    """The ``k`` most frequent words per group, with their place."""
    return top_words(word_counts(df, group, text, stop_words), group, "word", "n", k)


def hash_slot(text: Column, slots: Column | int) -> Column:
    """A slot from 0 to ``slots`` - 1 that depends on the text alone."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % slots


def joined_titles(df: DataFrame, group: str, text: str, per_chunk: int = 1000) -> DataFrame:
    """The distinct texts of each group joined with spaces, in chunks: ``group, chunk, joined``.

    A group has one chunk per ``per_chunk`` texts, so that no row grows with the group. Texts are spread
    over the chunks by hash and sorted inside; the chunks of a group laid end to end are its whole text.
    The distinct texts are staged, since they are read to size the groups and again to fill the chunks.
    """
    titles = staged(distinct_titles(df, group, text), "titles")
    sizes = titles.groupBy(group).agg(
        F.ceil(F.count(F.lit(1)) / per_chunk).cast("bigint").alias("_chunks")
    )
    chunk = hash_slot(F.col(text), F.col("_chunks")).alias("chunk")
    return (
        join_per_key(titles, sizes, group)
        .groupBy(group, chunk)
        .agg(F.array_join(F.sort_array(F.collect_list(text)), " ").alias("joined"))
    )


def idf_table(df: DataFrame, words: str, min_df: int = 0) -> DataFrame:
    """Inverse document frequency of each word: ``word, doc_freq, idf``; 0 below ``min_df`` documents.

    A word counts once per document; that is settled inside the row, before anything is shuffled.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    freq = (
        df.select(F.explode_outer(F.array_distinct(words)).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
    )
    idf = F.ln((total + 1) / (F.col("doc_freq") + 1))
    return freq.withColumn("idf", F.when(F.col("doc_freq") >= min_df, idf).otherwise(0.0))
