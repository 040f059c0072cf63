"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def real(value: Column) -> Column:
    """Value as a double with NaN turned into null."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def natural_log(value: Column) -> Column:
    """Natural logarithm; null for values that have none."""
    return F.when(value > 0, F.ln(value))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both values are present; null for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.when(
        (F.min(a) < F.max(a)) & (F.min(b) < F.max(b)), F.stddev_pop(a) * F.stddev_pop(b)
    )
    return F.try_divide(F.covar_pop(a, b), spread)
