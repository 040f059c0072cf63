"""Row filters, column shaping, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import text as tx


def require_non_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which all of ``cols`` are present."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def require_non_empty(df: DataFrame, text: str, any_of: Sequence[str]) -> DataFrame:
    """Rows with some text in ``text`` and in at least one of ``any_of``."""
    some = reduce(lambda a, b: a | b, [F.col(c) != "" for c in any_of])
    return df.where((F.col(text) != "") & some)


def years_between(df: DataFrame, day: str, first: int, last: int) -> DataFrame:
    """Rows of the years ``first`` to ``last``, with a ``year`` column.

    The range test is on the plain column, so Parquet can skip row groups.
    """
    start, end = F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last + 1), F.lit(1), F.lit(1))
    return df.where((F.col(day) >= start) & (F.col(day) < end)).withColumn("year", F.year(day))


def date_parts(df: DataFrame, day: str) -> DataFrame:
    """Adds ``year``, ``month`` and the first day of the month."""
    return df.withColumns(
        {"year": F.year(day), "month": F.month(day), "month_year": F.trunc(day, "month")}
    )


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN in ``cols`` (all columns by default)."""
    return df.na.drop("any", subset=list(cols) if cols else None)


def computed(df: DataFrame, value: Column, out: str) -> DataFrame:
    """``df`` with a costly column that later filters do not compute again.

    Catalyst pushes a filter below a projection by repeating the projected expression in it; it does not
    push one below a generator, so the column is made by one, of a single element.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != out]
    return df.select(*others, F.inline(F.array(F.struct(value.alias(out)))))


def clean_text(
    df: DataFrame, text: str, out: str = "title_clean", stop_words: Sequence[str] = ()
) -> DataFrame:
    """Adds the cleaned text; works on batch and streaming rows."""
    return computed(df, tx.rejoined(tx.without_words(tx.tokens(F.col(text)), stop_words)), out)


def split_pair(df: DataFrame, pair: str, first: str, second: str) -> DataFrame:
    """Adds the two elements of an array column; a short array gives nulls."""
    return df.withColumns(
        {
            first: tx.first_of_pair(F.col(pair)).cast("double"),
            second: tx.second_of_pair(F.col(pair)).cast("double"),
        }
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def split_rows(df: DataFrame, key: str, parts: int = 4) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows; one of ``parts`` hash slices of ``key`` is for validation.

    The slice depends on the key alone, so a re-run or a re-tried task splits alike.
    """
    slot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % parts
    return df.where(slot != 0), df.where(slot == 0)
