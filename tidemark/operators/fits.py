"""Fits of a column that are kept, merged and applied without reading the old rows again.

A fit is the additive state ``n, mean, m2, lo, hi``: count, mean, sum of squared deviations, smallest and largest value.
States of parts of a table merge to the state of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidemark.functions.numbers import real
from tidemark.operators.scaling import min_max_of, z_score_of

STATE = ("n", "mean", "m2", "lo", "hi")


def fit_states(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """One state per key, of the values that are numbers; a key without any has ``n`` = 0 and nulls."""
    x = real(F.col(col))
    state = [F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("lo"), F.max(x).alias("hi")]
    return df.groupBy(*by).agg(*state)


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of the same key as one: means weighted by counts, then deviations from the common mean.

    The deviations are summed around the merged mean and not around zero, so values far from zero keep their digits.
    """
    totals = states.groupBy(*by).agg(
        F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    if by:
        own = [F.col(f"_{k}") for k in by]
        means = totals.select(*[F.col(k).alias(f"_{k}") for k in by], F.col("mean").alias("_mean"))
        same = [F.col(k).eqNullSafe(o) for k, o in zip(by, own, strict=True)]
        placed = states.join(means, same).drop(*own)
    else:
        placed = states.withColumn("_mean", totals.select("mean").scalar())
    away = F.col("mean") - F.col("_mean")
    sums = placed.groupBy(*by).agg(F.sum(F.col("m2") + F.col("n") * away * away).alias("m2"))
    if by:
        sums = sums.select(*[F.col(k).alias(f"_{k}") for k in by], "m2")
        merged = totals.join(sums, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by])
        return merged.select(*by, *STATE)
    return totals.withColumn("m2", sums.select("m2").scalar()).select(*STATE)


def store_states(df: DataFrame, col: str, day: str, path: str, days: Sequence[date] | None = None) -> None:
    """Writes the state of every day, or anew those of the changed ``days`` alone; other days' rows and files are not touched.

    A changed day without rows keeps a state that counts nothing.
    """
    if days is None:
        fresh = fit_states(df.where(F.col(day).isNotNull()), col, [day])
    else:
        # A literal list of days reaches the scan, so a table with a folder per day is read for these alone.
        found = fit_states(df.where(F.col(day).isin(list(days))), col, [day])
        listed = df.sparkSession.createDataFrame([(d,) for d in sorted(set(days))], f"{day} date")
        fresh = listed.join(found, day, "left").na.fill(0, ["n"])
    writer = fresh.withColumnRenamed(day, "day").write.mode("overwrite").partitionBy("day")
    writer.option("partitionOverwriteMode", "static" if days is None else "dynamic").parquet(path)


def load_states(spark: SparkSession, path: str) -> DataFrame:
    """``day`` and the state of each."""
    return spark.read.schema("n bigint, mean double, m2 double, lo double, hi double, day date").parquet(path)


def _fit(state: Row) -> Column:
    numbers = {k: F.lit(state[k]).cast("double") for k in ("mean", "m2", "lo", "hi")}
    return F.struct(*[v.alias(k) for k, v in numbers.items()], F.sqrt(F.try_divide(numbers["m2"], F.lit(state["n"]))).alias("std"))


def scale_with(df: DataFrame, col: str, out: str, state: Row, kind: str = "min_max") -> DataFrame:
    """``col`` scaled by a merged state; a formula without a join, the same for a table and a stream.

    ``kind`` is ``min_max`` or ``z_score``. Values beyond those of the fit lie outside [0, 1].
    """
    if kind not in ("min_max", "z_score"):
        raise ValueError("kind is min_max or z_score")
    formula = min_max_of if kind == "min_max" else z_score_of
    return df.withColumn(out, formula(real(F.col(col)), _fit(state)))


def scale_by_key(df: DataFrame, col: str, out: str, states: DataFrame, by: str, kind: str = "z_score") -> DataFrame:
    """``col`` scaled by the merged state of its key; null where the key has none."""
    formula = min_max_of if kind == "min_max" else z_score_of
    fit = F.struct("mean", F.sqrt(F.try_divide("m2", "n")).alias("std"), "lo", "hi")
    fits = states.where(F.col(by).isNotNull()).select(by, fit.alias("_fit"))
    return df.join(fits, by, "left").withColumn(out, formula(real(F.col(col)), F.col("_fit"))).drop("_fit")
