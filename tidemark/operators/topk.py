"""The best scores of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import join_per_key, staged

TOP_SCORES = 100
# Spark cuts each task to k rows per group up to this k; beyond it groups are cut in parts first.
GROUP_LIMIT, PARTS = 1000, 64


def distinct_scores(df: DataFrame, group: str, score: str) -> DataFrame:
    """Distinct ``(group, score)`` pairs; repeats collapse before the shuffle."""
    return df.where(F.col(group).isNotNull() & F.col(score).isNotNull()).select(group, score).distinct()


def _best(pairs: DataFrame, group: str, score: str, k: int) -> DataFrame:
    """The ``k`` best rows per group of a table that has each score once per group.

    Spark limits each task to ``k`` rows per group before it shuffles by group, so a group that holds
    a third of the table sends no more than ``k`` rows per task.
    """
    return _ranked(pairs, group, score, [F.desc(score)], k, "_place").drop("_place")


def _ranked(rows: DataFrame, group: str, spread: str, order: Sequence[Column], k: int, out: str) -> DataFrame:
    """The first ``k`` rows of each group with their place; for a large ``k`` first those of each part of a group."""
    if k > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(spread), F.lit(PARTS))
        place = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
        rows = rows.withColumn("_part", part).withColumn(out, place).where(F.col(out) <= k).drop("_part", out)
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn(out, place).where(F.col(out) <= k)


def top_distinct(df: DataFrame, group: str, score: str, k: int = TOP_SCORES) -> DataFrame:
    """The ``k`` highest distinct scores of each group, one row each."""
    return _best(distinct_scores(df, group, score), group, score, k)


def top_scores(df: DataFrame, group: str, score: str, k: int = TOP_SCORES) -> DataFrame:
    """The same as a descending array per group; an array has at most ``k`` elements."""
    best = top_distinct(df, group, score, k)
    return best.groupBy(group).agg(F.sort_array(F.collect_list(score), asc=False).alias("scores"))


def keep_top_distinct(df: DataFrame, group: str, score: str, k: int = TOP_SCORES) -> DataFrame:
    """Rows whose score is among the ``k`` highest distinct scores of their group, ties included.

    Only the lowest kept score per group is joined back. The rows themselves are not ranked, hence
    not gathered by group, however many tie.
    """
    cut = top_distinct(df, group, score, k).groupBy(group).agg(F.min(score).alias("_cut"))
    return join_per_key(df, cut, group).where(F.col(score) >= F.col("_cut")).drop("_cut")


def keep_top_listed(df: DataFrame, group: str, score: str, k: int = TOP_SCORES) -> DataFrame:
    """The same rows by testing membership in the group's list of best scores."""
    lists = staged(top_scores(df, group, score, k), "top-scores")
    return df.join(lists, group).where(F.array_contains("scores", F.col(score))).drop("scores")


def top_distinct_mean(
    df: DataFrame, group: str, score: str, value: str, out: str, k: int = TOP_SCORES
) -> DataFrame:
    """Mean of ``value`` over the rows :func:`keep_top_distinct` keeps, without a join.

    Rows are first summed per ``(group, score)``; ties then are one row, the cut is made on these rows
    and their sums add up to the mean.
    """
    cells = (
        df.where(F.col(group).isNotNull() & F.col(score).isNotNull())
        .groupBy(group, score)
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    )
    return (
        _best(cells, group, score, k)
        .groupBy(group)
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias(out))
    )


def top_words(counts: DataFrame, group: str, word: str, count: str, k: int) -> DataFrame:
    """The ``k`` most frequent words of each group, by word on a tie."""
    return _ranked(counts, group, word, [F.desc(count), F.col(word)], k, "place")
