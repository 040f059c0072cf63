"""Most frequent words without a shuffle of every word.

Each task keeps a bounded summary of every group's words (Misra and Gries): some words with counts that are too low by
at most the summary's error. Together the summaries prove which words can't be among the most frequent ones; the
others are then counted exactly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.topk import top_words
from tidemark.operators.words import PICTURE_STOP_WORDS, distinct_titles, word_counts
from tidemark.session import join_per_key, staged

CAPACITY = 20_000  # words that a summary keeps


class Summary:
    """Counts of at most ``2 * capacity`` words; each is too low by at most ``error``, and so is that of a word not there."""

    def __init__(self, capacity: int):
        self.capacity, self.counts, self.error = capacity, defaultdict(int), 0

    def add(self, words: list[str]) -> None:
        counts = self.counts
        for w in words:
            counts[w] += 1
        if len(counts) > 2 * self.capacity:
            self.shrink()

    def shrink(self) -> None:
        """Takes from all counts what the first word beyond the capacity has, so that it and all below go."""
        if len(self.counts) > self.capacity:
            values = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            less = int(np.partition(values, len(values) - self.capacity - 1)[len(values) - self.capacity - 1])
            self.error += less
            self.counts = defaultdict(int, {w: n - less for w, n in self.counts.items() if n > less})


def summaries(titles: DataFrame, group: str, text: str, stop_words: Sequence[str], capacity: int) -> DataFrame:
    """``group, word, n`` per task, and a row with a null word that has the task's error for the group."""
    stops = set(stop_words) | {""}
    kind = titles.schema[group].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[object, Summary] = {}
        for batch in batches:
            of = batch.schema.field(group).type
            for g, t in zip(batch.column(group).to_pylist(), batch.column(text).to_pylist(), strict=True):
                found.setdefault(g, Summary(capacity)).add([w for w in t.split(" ") if w not in stops])
        for g, summary in found.items():
            summary.shrink()
            words, counts = [None, *summary.counts], [summary.error, *summary.counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(words), of), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=[group, "word", "n"])

    return titles.select(group, text).mapInArrow(run, f"`{group}` {kind.simpleString()}, word string, n bigint")


def frequent_words(
    df: DataFrame, group: str, text: str, k: int, stop_words: Sequence[str] = PICTURE_STOP_WORDS, capacity: int = CAPACITY
) -> DataFrame:
    """The rows of :func:`tidemark.operators.words.word_freq`, for texts whose distinct words are very many.

    A word's count lies between the sum of its summaries and that plus the errors of all tasks. Words whose upper bound
    is below the k-th largest lower bound of their group can't be among its first ``k``; the others are counted exactly.
    A group whose bounds prove nothing, since its k-th lower bound is not above what a word in no summary may have,
    is counted in full. Nothing is left out and ties are as they are there.
    """
    titles = staged(distinct_titles(df, group, text), "titles")
    parts = staged(summaries(titles, group, text, stop_words, capacity), "summaries")
    errors = parts.where(F.col("word").isNull()).groupBy(group).agg(F.sum("n").alias("_error"))
    low = staged(parts.where(F.col("word").isNotNull()).groupBy(group, "word").agg(F.sum("n").alias("n")), "lower-bounds")
    least = top_words(low, group, "word", "n", k).where(F.col("place") == k).select(group, F.col("n").alias("_least"))
    bounds = staged(errors.join(least, group, "left"), "bounds")
    proven = F.coalesce(F.col("_least") > F.col("_error"), F.col("_error") == 0)
    told = bounds.select(group, "_error", F.coalesce("_least", F.lit(0)).alias("_least"), proven.alias("_proven"))
    asked = join_per_key(low, told, group).where(F.col("_proven") & (F.col("n") + F.col("_error") >= F.col("_least"))).select(group, "word")
    asked = staged(asked, "asked")
    # Words that the summaries have ruled out go before the shuffle, in the tasks that read them.
    listed = titles.select(group, F.explode_outer(F.split(text, " ")).alias("word")).where(F.col("word") != "")
    kept = listed.join(asked, [group, "word"], "left_semi").groupBy(group, "word").agg(F.count(F.lit(1)).alias("n"))
    rest = told.where(~F.col("_proven")).select(group)
    whole = word_counts(titles.join(rest, group, "left_semi"), group, text, stop_words)
    return top_words(kept.unionByName(whole), group, "word", "n", k)
