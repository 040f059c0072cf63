"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs of other characters than space, tab, line feed, vertical tab, form feed and return. On
# UTF-8 bytes these are exactly what ``bytes.split()`` cuts at, and ``bytes.lower()`` changes A-Z only.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return text.encode() if text else b""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Words of a text; none for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores before one that a column has; Spark doesn't tell case apart."""
    there = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in there:
            name = f"_{name}"
        there.add(name.lower())
        found.append(name)
    return found


def repeated(df: DataFrame, times: str, most: int = 10_000) -> DataFrame:
    """Every row as often as its column ``times`` says, which goes; no array has more than ``most`` entries."""
    part, turn = unused(df.columns, "part", "turn")
    parts = df.where(F.col(times) > 0).withColumn(part, F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / most))))
    left = F.least(F.col(times) - F.col(part) * most, F.lit(most)).cast("int")
    return parts.withColumn(turn, F.explode(F.sequence(F.lit(1), left))).drop(times, part, turn)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, one batch at a time."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def groups_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """Rows that stand sorted by ``keys``, numbers all, one group of equal keys at a time."""
    held = None
    for batch in batches:
        batch = batch if held is None else pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)
        held = batch.slice(starts[-1])  # it may go on in the next batch
    if held is not None:
        yield held


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows back to Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
