"""Runs of a stream that end in time and lose or repeat nothing."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_batches(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False) -> StreamingQuery:
    """Starts a stream into a folder per micro-batch; a batch that is run again replaces its first try, so rows are there once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_for(query: StreamingQuery, seconds: float, batches: int | None = None, poll: float = 0.05) -> int:
    """Lets a stream run until ``seconds`` are over or it has committed ``batches``, then drains and stops it.

    The batch that runs at the deadline is waited for. One that begins before the stop reaches the query is cut off and
    run again when the stream goes on from its checkpoint; the sink of :func:`write_batches` then has it once. A query
    that ends by itself is waited for no longer, and one that fails raises. Returns the number of the last batch that is
    known to be done, -1 without any.
    """
    deadline = time.monotonic() + seconds
    seen = -1

    def last() -> int:
        progress = query.lastProgress
        return seen if progress is None else max(seen, int(progress["batchId"]))

    first = None
    while query.isActive and time.monotonic() < deadline:
        query.awaitTermination(poll)
        seen = last()
        if first is None and seen >= 0:
            first = seen
        if batches is not None and first is not None and seen - first + 1 >= batches:
            break
    running = last()
    while query.isActive:
        if not query.status["isTriggerActive"] or last() > running:
            query.stop()
            break
        query.awaitTermination(poll)
    if (error := query.exception()) is not None:
        raise error
    return last()
