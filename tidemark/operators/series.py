"""Daily series of many keys at once.

Every operator starts from :func:`daily_series`: one row per key and calendar day. The rows of a key
are thus pre-aggregated before the shuffle, and a window partition holds at most one row per day (some
366 a year) however many rows the key has in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numbers import natural_log, real
from tidemark.operators.scaling import z_score

DECOMPOSE_PERIOD = 28


def daily_series(df: DataFrame, key: str, day: str, col: str) -> DataFrame:
    """Mean of ``col`` per key and day; a day without any value stays as a null row."""
    return (
        df.where(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, F.col(day).cast("date").alias(day))
        .agg(F.avg(real(F.col(col))).alias(col))
    )


def _in_order(key: str, day: str):
    return Window.partitionBy(key).orderBy(day)


def lag_diff(df: DataFrame, key: str, day: str, col: str, n: int = 1) -> DataFrame:
    """Adds the value ``n`` rows before and the difference to it."""
    lagged = F.lag(col, n).over(_in_order(key, day))
    return (
        daily_series(df, key, day, col)
        .withColumn("lagged", lagged)
        .withColumn("difference", F.col(col) - F.col("lagged"))
    )


def log_series(df: DataFrame, key: str, day: str, col: str, out: str) -> DataFrame:
    """Adds the natural logarithm of the daily value."""
    return daily_series(df, key, day, col).withColumn(out, natural_log(F.col(col)))


def interpolate_linear(df: DataFrame, key: str, day: str, col: str, out: str) -> DataFrame:
    """Fills gaps on a straight line by row position.

    Leading gaps stay null, trailing gaps take the last value. The value after a gap comes from a
    running frame in descending order: a frame that looks ahead to the end costs the square of the
    series length.
    """
    ahead = Window.partitionBy(key).orderBy(F.desc(day))
    place = F.row_number().over(_in_order(key, day))
    known = F.when(F.col(col).isNotNull(), F.struct(F.col("_place").alias("at"), F.col(col).alias("v")))
    x, before, after = F.col(col), F.col("_before"), F.col("_after")
    line = before["v"] + (after["v"] - before["v"]) * (
        (F.col("_place") - before["at"]) / (after["at"] - before["at"])
    )
    return (
        daily_series(df, key, day, col)
        .withColumn("_place", place)
        .withColumn("_before", F.last(known, True).over(_in_order(key, day)))
        .withColumn("_after", F.last(known, True).over(ahead))
        .withColumn(out, F.coalesce(x, F.when(after.isNull(), before["v"]).otherwise(line)))
        .drop("_place", "_before", "_after")
    )


def _centred_mean(x: Column, order, period: int) -> Column:
    """Centred moving average over one period; an even period weighs both end rows by half."""
    half = period // 2
    full = F.count(x).over(order.rowsBetween(-half, half)) == 2 * half + 1
    if period % 2:
        total = F.sum(x).over(order.rowsBetween(-half, half))
    else:
        inner = F.sum(x).over(order.rowsBetween(-half + 1, half - 1))
        total = inner + 0.5 * (F.lag(x, half).over(order) + F.lead(x, half).over(order))
    return F.when(full, total / period)


def decompose(
    df: DataFrame,
    key: str,
    day: str,
    col: str,
    period: int = DECOMPOSE_PERIOD,
    model: str = "multiplicative",
) -> DataFrame:
    """Classical decomposition into ``trend``, ``seasonality`` and ``residual``.

    A key that cannot be decomposed keeps its rows, with nulls and the reason in ``issue``. All windows
    share one shuffle by key.
    """
    if model not in ("multiplicative", "additive"):
        raise ValueError("model is multiplicative or additive")
    product = model == "multiplicative"
    order, whole = _in_order(key, day), Window.partitionBy(key)
    x, sound = F.col(col), F.col("issue").isNull()

    issue = F.when(F.count(F.lit(1)).over(whole) < 2 * period, "fewer than two periods").when(
        F.count(x).over(whole) < F.count(F.lit(1)).over(whole), "missing values"
    )
    if product:
        issue = issue.when(F.min(x).over(whole) <= 0, "values not above zero")

    def apart(a: Column, b: Column) -> Column:
        return F.try_divide(a, b) if product else a - b

    # The first `period` rows of a key hold each phase once: their phase means average to the centre.
    centre = F.sum(F.when(F.col("_place") < period, F.col("_phase_mean"))).over(whole) / period
    return (
        daily_series(df, key, day, col)
        .withColumn("_place", F.row_number().over(order) - 1)
        .withColumn("trend", _centred_mean(x, order, period))
        .withColumn("issue", issue)
        .withColumn("trend", F.when(sound, F.col("trend")))
        .withColumn("_phase", F.col("_place") % period)
        .withColumn(
            "_phase_mean", F.avg(apart(x, F.col("trend"))).over(Window.partitionBy(key, "_phase"))
        )
        .withColumn("seasonality", F.when(sound, apart(F.col("_phase_mean"), centre)))
        .withColumn("residual", apart(apart(x, F.col("seasonality")), F.col("trend")))
        .select(key, day, col, "trend", "seasonality", "residual", "issue")
    )


def unfit(
    df: DataFrame,
    key: str,
    day: str,
    col: str,
    period: int = DECOMPOSE_PERIOD,
    model: str = "multiplicative",
) -> DataFrame:
    """``key, issue``: the keys that cannot be decomposed and why, one row each.

    The same rules as in :func:`decompose`, from one row of counts per key.
    """
    counts = daily_series(df, key, day, col).groupBy(key).agg(
        F.count(F.lit(1)).alias("_days"), F.count(col).alias("_known"), F.min(col).alias("_least")
    )
    issue = F.when(F.col("_days") < 2 * period, "fewer than two periods").when(
        F.col("_known") < F.col("_days"), "missing values"
    )
    if model == "multiplicative":
        issue = issue.when(F.col("_least") <= 0, "values not above zero")
    return counts.select(key, issue.alias("issue")).where(F.col("issue").isNotNull())


def decomposed_features(
    df: DataFrame, key: str, day: str, col: str, period: int = DECOMPOSE_PERIOD
) -> DataFrame:
    """Complete rows of the decomposition with the first difference and the standardised residual.

    The residual is standardised per key, over the complete rows.
    """
    parts = decompose(df, key, day, col, period).where(F.col("issue").isNull())
    rows = parts.withColumn(
        "difference", F.col(col) - F.lag(col).over(_in_order(key, day))
    ).na.drop("any", subset=["trend", "seasonality", "residual", "difference"])
    whole = Window.partitionBy(key)
    mean, std = F.avg("residual").over(whole), F.stddev_pop("residual").over(whole)
    flat = F.min("residual").over(whole) == F.max("residual").over(whole)
    return rows.withColumn(
        "standardized_residual",
        F.when(flat, 0.0).otherwise(F.try_divide(F.col("residual") - mean, std)),
    ).select(key, day, "trend", "seasonality", "residual", "difference", "standardized_residual")


def standardized_daily(df: DataFrame, day: str, col: str, out: str) -> DataFrame:
    """One row per day with the mean of ``col`` and its z-score over all days."""
    days = (
        df.where(F.col(day).isNotNull())
        .groupBy(F.col(day).cast("date").alias(day))
        .agg(F.avg(real(F.col(col))).alias(col))
    )
    return z_score(days, col, out)
