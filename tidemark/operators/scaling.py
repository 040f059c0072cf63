"""Means and column scaling, over the whole table or per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import real
from tidemark.session import with_fit


def group_mean(df: DataFrame, group: str, col: str, out: str) -> DataFrame:
    """Mean of ``col`` per group; rows without a group are left out."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(col).alias(out))


def min_max_of(x: Column, fit: Column) -> Column:
    """``x`` by a fit's ``lo`` and ``hi``; 0.5 where these are equal."""
    scaled = F.when(fit["hi"] == fit["lo"], 0.5).otherwise(F.try_divide(x - fit["lo"], fit["hi"] - fit["lo"]))
    return F.when(x.isNotNull(), scaled)


def z_score_of(x: Column, fit: Column) -> Column:
    """``x`` by a fit's ``mean`` and ``std``; 0 where its ``lo`` and ``hi`` are equal."""
    scaled = F.when(fit["hi"] == fit["lo"], 0.0).otherwise(F.try_divide(x - fit["mean"], fit["std"]))
    return F.when(x.isNotNull(), scaled)


def min_max(df: DataFrame, col: str, out: str, by: str | None = None) -> DataFrame:
    """``col`` scaled to [0, 1]; 0.5 where the smallest and largest value are equal."""
    x = real(F.col(col))
    fit = F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))
    return with_fit(df, fit, by).withColumn(out, min_max_of(x, F.col("_fit"))).drop("_fit")


def z_score(df: DataFrame, col: str, out: str, by: str | None = None) -> DataFrame:
    """``col`` minus its mean over its population standard deviation; 0 for a constant column."""
    x = real(F.col(col))
    fit = F.struct(
        F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("lo"), F.max(x).alias("hi")
    )
    return with_fit(df, fit, by).withColumn(out, z_score_of(x, F.col("_fit"))).drop("_fit")
