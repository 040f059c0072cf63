"""Statistics of price bars per company and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import month_of


def price_stats(
    df: DataFrame, company: str = "Company", price: str = "Open", volume: str = "Volume"
) -> DataFrame:
    """Highest and lowest price, mean and lowest volume of each company, in one pass."""
    return (
        df.where(F.col(company).isNotNull())
        .groupBy(company)
        .agg(
            F.max(price).alias("max_open"),
            F.min(price).alias("min_open"),
            F.avg(volume).alias("mean_volume"),
            F.min(volume).alias("min_volume"),
        )
    )


def monthly_mean(
    df: DataFrame, col: str, out: str, company: str = "Company", day: str = "Date"
) -> DataFrame:
    """Mean of ``col`` per company and month; ``month_year`` is the month's first day."""
    return (
        df.where(F.col(company).isNotNull() & F.col(day).isNotNull())
        .groupBy(company, month_of(F.col(day)).alias("month_year"))
        .agg(F.avg(col).alias(out))
    )


def companies(df: DataFrame, company: str = "Company") -> DataFrame:
    """Each company once."""
    return df.select(company).distinct()


def total_of(
    df: DataFrame, company_name: str, col: str, out: str, company: str = "Company"
) -> DataFrame:
    """Sum of ``col`` over one company's rows."""
    return df.where(F.col(company) == company_name).agg(F.sum(col).alias(out))
