"""Reading a table page by page along a key."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import staged

# Where a read starts by default (1 January 2008 in epoch seconds) and its page size.
DEFAULT_START = 1199174400
DEFAULT_PAGE = 500


def keyset_page(
    df: DataFrame, order: Sequence[str], after: Sequence[Any] | None = None, size: int = DEFAULT_PAGE
) -> DataFrame:
    """The next ``size`` rows after the key ``after``, in ascending order.

    Rows that share the first key column with ``after`` are not lost: the whole key is compared. The
    plain test on the first column is redundant but reaches the file scan.
    """
    if after is not None:
        key = F.struct(*[F.col(c) for c in order])
        last = F.struct(
            *[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after, strict=True)]
        )
        df = df.where((F.col(order[0]) >= last[order[0]]) & (key > last))
    return df.orderBy(*order).limit(size)


def number_pages(df: DataFrame, order: Sequence[str], size: int = DEFAULT_PAGE) -> DataFrame:
    """Every row with the ``page`` it falls on and its ``place`` in the page, both from 0.

    Rows are range-partitioned and sorted by the key, numbered inside their range and staged; the numbers
    are then shifted by the row counts of the ranges before. One shuffle, and no task sees the whole
    table. The key must be unique: its last columns then split the range of a value that many rows share.
    """
    in_range = F.monotonically_increasing_id()  # range number in the upper bits, row in the lower 33
    ranged = staged(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", in_range), "ranges"
    ).withColumns({"_part": F.shiftright("_at", 33), "_rank": F.col("_at").bitwiseAND(2**33 - 1)})
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range: a table as long as the number of shuffle partitions.
    before = F.coalesce(
        F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = sizes.select("_part", before.alias("_start"))
    position = F.col("_start") + F.col("_rank")
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumns(
            {"page": F.floor(position / size).cast("bigint"), "place": (position % size).cast("bigint")}
        )
        .drop("_at", "_part", "_rank", "_start")
    )


def page_documents(df: DataFrame, order: Sequence[str], size: int = DEFAULT_PAGE) -> DataFrame:
    """One row per page: ``page, after, rows, body``; ``body`` is the page as a JSON array.

    ``after`` is the first key column of the last row of the page before, that is, the cursor with which
    the page was asked for (null for the first). A page holds ``size`` rows at most.
    """
    cols = [F.col(c) for c in df.columns]
    entry = F.struct(F.col("place"), F.struct(*cols).alias("entry"))
    pages = (
        number_pages(df, order, size)
        .groupBy("page")
        .agg(
            F.max(order[0]).alias("_last"),
            F.count(F.lit(1)).alias("rows"),
            F.to_json(F.sort_array(F.collect_list(entry))["entry"]).alias("body"),
        )
    )
    next_page = pages.select((F.col("page") + 1).alias("page"), F.col("_last").alias("after"))
    return pages.join(next_page, "page", "left").select("page", "after", "rows", "body")
