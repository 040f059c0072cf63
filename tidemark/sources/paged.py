"""A data source over a feed that hands out rows page by page, as a table or as a stream."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.operators.paging import DEFAULT_PAGE, DEFAULT_START

# A fetch gets (time, id) of the last row it gave or (time, None) at the start, the end of the wanted
# time range (exclusive) and a page size. It returns the next rows in ascending (time, id) order, each as
# a tuple that begins with time and id; an empty page ends the range.
Fetch = Callable[[tuple, int, int], list[tuple]]
# The key (time, id) of the feed's last row, or None while it has none.
Newest = Callable[[], tuple | None]


class TimeSlice(InputPartition):
    """Rows with ``low <= time < high``, of the first second only those after the id ``after``, none after the key ``last``."""

    def __init__(self, low: int, high: int, after: Any = None, last: tuple | None = None):
        self.low, self.high, self.after, self.last = low, high, after, last


def slices(low: int, high: int, width: int) -> list[TimeSlice]:
    return [TimeSlice(a, min(a + width, high)) for a in range(low, high, width)]


def slices_between(start: dict, end: dict, width: int, overlap: int = 0, least: int = 0) -> list[TimeSlice]:
    """Slices of the rows after the key ``start`` up to ``end``; with ``overlap`` also those of so many seconds before ``start``."""
    if end["id"] is None or (end["time"], end["id"]) == (start["time"], start["id"]) or end["time"] < start["time"]:
        return []
    low = max(start["time"] - overlap, least)
    found = slices(low, end["time"] + 1, width)
    if low == start["time"] and not overlap:
        found[0].after = start["id"]
    found[-1].last = (end["time"], end["id"])
    return found


def read_slice(fetch: Fetch, part: TimeSlice, size: int) -> Iterator[tuple]:
    """All rows of a time slice, one page in memory at a time."""
    after: tuple = (part.low, part.after)
    while page := fetch(after, part.high, size):
        for row in page:
            if part.last is not None and (row[0], row[1]) > part.last:
                return
            yield row
        after = (page[-1][0], page[-1][1])


def paged_source(name: str, schema: str, fetch: Fetch, newest: Newest | None = None) -> type[DataSource]:
    """A source class to register with ``spark.dataSource.register``.

    The time range is cut into slices of ``slice`` seconds, which executors read side by side; inside a
    slice the cursor is the whole key ``(time, id)``, so rows that share a second are not lost at a page
    edge. Options: ``start``, ``end`` (epoch seconds; now if not set), ``slice``, ``size``.

    A stream needs ``newest`` and has no end. Its offset is the key of the last row it has delivered: a feed without
    new rows starts no batch, and a batch that is run again reads the same range of keys. With the option ``overlap``
    a batch also reads the seconds before its start again, for rows that the feed has shown late; :func:`follow`
    then removes what was delivered before.
    """

    class _Options:
        def __init__(self, options):
            self.start = int(options.get("start", DEFAULT_START))
            self.end = int(options["end"]) if "end" in options else None
            self.width = int(options.get("slice", 86400))
            self.size = int(options.get("size", DEFAULT_PAGE))
            self.overlap = int(options.get("overlap", 0))

        def horizon(self) -> int:
            return int(time.time()) if self.end is None else self.end

    class _Batch(DataSourceReader):
        def __init__(self, options):
            self.options = _Options(options)

        def partitions(self):
            return slices(self.options.start, self.options.horizon(), self.options.width)

        def read(self, partition):
            return read_slice(fetch, partition, self.options.size)

    class _Stream(DataSourceStreamReader):
        def __init__(self, options):
            self.options = _Options(options)

        def initialOffset(self):
            return {"time": self.options.start, "id": None}

        def latestOffset(self):
            key = newest()
            if key is None or key[0] < self.options.start:
                return self.initialOffset()
            return {"time": key[0], "id": key[1]}

        def partitions(self, start, end):
            return slices_between(start, end, self.options.width, self.options.overlap, self.options.start)

        def read(self, partition):
            return read_slice(fetch, partition, self.options.size)

        def commit(self, end):
            pass

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return _Batch(self.options)

        def streamReader(self, schema):
            if newest is None:
                raise ValueError("a stream of this feed needs the key of its last row")
            return _Stream(self.options)

    return Paged


def follow(spark: SparkSession, name: str, key: tuple[str, str] = ("created_utc", "id"), overlap: int = 0, **options) -> DataFrame:
    """A registered feed as a stream of rows, each once, although its seconds are read again for late ones.

    A row that the feed shows up to ``overlap`` seconds behind its newest row comes with the next batch; one that is
    shown later still is not read. Keys are held as state for twice that time. The first name of ``key`` is a column of
    epoch seconds.
    """
    rows = spark.readStream.format(name).options(overlap=overlap, **options).load()
    if not overlap:
        return rows
    timed = rows.withColumn("_when", F.timestamp_seconds(key[0])).withWatermark("_when", f"{overlap + 1} seconds")
    return timed.dropDuplicatesWithinWatermark(list(key)).drop("_when")
