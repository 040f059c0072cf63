"""Document fingerprints by winnowing.

All k-grams of code points are hashed; of every window of consecutive hashes the smallest is kept, of equal ones the
rightmost, with its position. Two texts that share a run of ``window + k - 1`` code points share a kept hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import batches_of, repeated, rows_of
from tidemark.llm.shingles import STEP, mixed
from tidemark.session import staged

K, WINDOW = 16, 16


def kgram_hashes(text: str, k: int) -> np.ndarray:
    """Hashes of all k-grams; a shorter text is one gram, an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    k = min(k, len(codes))
    if not k:
        return np.empty(0, np.uint64)
    count = len(codes) - k + 1
    hashes = np.full(count, k, np.uint64)
    for i in range(k):
        hashes *= STEP
        hashes += codes[i : i + count]
    return mixed(hashes)


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept, ascending. Fewer hashes than a window has are one window."""
    if not len(hashes):
        return np.empty(0, np.int64)
    window = min(window, len(hashes))
    value, at, size = hashes, np.arange(len(hashes)), 1
    while size < window:
        step = min(size, window - size)  # the two halves may overlap
        count = len(value) - step
        right = value[step:] <= value[:count]
        at = np.where(right, at[step:], at[:count])
        value = np.where(right, value[step:], value[:count])
        size += step
    return at[np.append(True, at[1:] != at[:-1])]


def fingerprint(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions."""
    hashes = kgram_hashes(text or "", k)
    at = winnowed(hashes, window)
    return hashes[at], at


def digest(found: tuple[np.ndarray, np.ndarray]) -> str:
    """32 hexadecimal digits of a fingerprint's hashes and positions."""
    made = hashlib.blake2b(found[0].tobytes(), digest_size=16)
    made.update(found[1].astype("<i8").tobytes())
    return made.hexdigest()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Shared distinct hashes over all of both; 1 for two fingerprints without hashes."""
    one, other = np.unique(one), np.unique(other)
    both = len(np.intersect1d(one, other, assume_unique=True))
    every = len(one) + len(other) - both
    return both / every if every else 1.0


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, hashes, positions``, one row per row of ``docs``; a null text is empty and has no hashes."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(t or ""), *(x.tolist() for x in fingerprint(t, k, window))) for (t,) in rows_of([batch], "text")]
            sizes, hashes, places = zip(*found, strict=True) if found else ((), (), ())
            hashes = [[h - (1 << 63) for h in x] for x in hashes]
            columns = [pa.array(sizes, pa.int64()), pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_chars", "hashes", "positions"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars bigint, hashes array<bigint>, positions array<bigint>")


LEAST = -(1 << 63)  # of a hash


def _cuts(rows: int, wanted: float) -> list[int]:
    """Hashes that deal ``rows`` of one id to ranges of about ``wanted``; the first is the least hash."""
    count = max(1, min(round(rows / wanted), 1 << 20))
    return [LEAST + (k << 64) // count for k in range(count)]


def _part_of(points: list[tuple[int, int]], of_null: list[int]) -> Column:
    """The number of the range between the given points of id and hash; below 0 for a null id."""
    ids, hashes = (np.array([p[k] for p in points], np.int64) for k in (0, 1))
    nulls = np.array(of_null, np.int64)

    @F.pandas_udf("int")
    def number(key: pd.Series, missing: pd.Series, told: pd.Series) -> pd.Series:
        key, missing, told = (c.to_numpy() for c in (key, missing, told))
        low, high = np.searchsorted(ids, key, side="left"), np.searchsorted(ids, key, side="right")
        part = high.copy()
        for at in np.unique(low[high - low > 1]):  # an id that very many rows have is cut by their hashes
            rows = (low == at) & (high - low > 1)
            part[rows] = at + np.searchsorted(hashes[at : high[rows][0]], told[rows], side="right")
        part[missing] = np.searchsorted(nulls, told[missing], side="right") - len(nulls) - 1
        return pd.Series(part.astype(np.int32))

    return number(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), F.col("doc_id").isNull(), F.col("_hash"))


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows by descending id in sorted ranges: ``doc_id, text, n, part, guest``.

    Equal ids are ordered by the hash of their text, null ids are last; rows equal in both are one row, ``n`` times
    there. A range's last row is followed by a ``guest``, the first row of the next range (after the last: of the
    first), so every row's successor is in its task. An id that very many rows have is in several ranges, cut by the
    hash. One shuffle of texts; only the ranges' borders and first rows' ids come to the driver.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError("ids must be whole numbers")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_hash"))
    keys = staged(rows.groupBy("doc_id", "_hash").agg(F.count(F.lit(1)).alias("n")), "keys")
    again = keys.where("n > 1")
    if again.isEmpty():
        rows = rows.withColumn("n", F.lit(1).cast("bigint"))
    else:
        # Equal rows meet in each task first, so a row that is there very often is not gathered.
        many = again.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_of"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of"))
        once = rows.join(many, same).groupBy("doc_id", "_hash").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
        rows = rows.join(many, same, "left_anti").withColumn("n", F.lit(1).cast("bigint")).unionByName(once)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = 4 * parts  # several ranges a task, so tasks are even
    wanted = max(keys.count() / count, 1.0)
    quantiles = keys.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.25 / count)
    points = {(int(q), LEAST) for q in quantiles}
    of_null: list[int] = []
    for row in keys.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 2 * wanted).collect():  # count / 2 at most
        cuts, doc = _cuts(row["rows"], wanted), row["doc_id"]
        if doc is None:
            of_null = cuts[1:]
        else:
            points |= {(doc, c) for c in cuts} | ({(doc + 1, LEAST)} if doc < (1 << 63) - 1 else set())
    part = _part_of(sorted(points), of_null)
    rows = rows.withColumn("part", part)
    heads = keys.withColumn("part", part).groupBy("part").agg(F.max(F.struct("doc_id", "_hash")).alias("head")).collect()  # one row per range
    heads.sort(key=lambda r: -r["part"])
    to = [(h["head"]["doc_id"], h["head"]["_hash"], heads[k - 1]["part"]) for k, h in enumerate(heads)]
    kind = rows.schema["doc_id"].dataType.simpleString()
    wanted_rows = spark.createDataFrame(to, f"_id {kind}, _of bigint, _to int")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of"))
    guests = rows.join(F.broadcast(wanted_rows), same).select("doc_id", "text", "_hash", "n", F.col("_to").alias("part"))
    every = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    ordered = every.repartition(parts, "part").sortWithinPartitions(
        F.desc("part"), "guest", F.desc_nulls_last("doc_id"), F.desc("_hash")
    )
    return ordered.select("doc_id", "text", "n", "part", "guest")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following one, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edited(docs: DataFrame, k: int = K, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row, of its edited text, and their likeness; one row per row of ``docs``.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The next document is
    the next lower id (of rows with equal ids, that with the next lower text hash, of rows equal in both another one;
    after the last: the first, which for a single row is the row itself). Ids are whole numbers, else it raises; null
    ids are last. A null text is empty, very long ones are read whole. Other columns are not read; an empty table
    gives none.
    """
    rows = neighbours(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, last = None, None  # last: id, text, times, part and fingerprint of the row before

        def compared(doc: int, one: str, found: tuple, other: str, next_found: tuple, times: int) -> tuple:
            changed = edited(one, other)
            after = fingerprint(changed, k, window)
            hexed = hashlib.sha256(changed.encode()).hexdigest()
            return doc, len(one), hexed, digest(found), digest(after), likeness(found[0], after[0]), likeness(found[0], next_found[0]), times

        for batch in batches:
            out = []
            if fields is None:
                plain = [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
                numbers = [("near_edited", pa.float64()), ("near_next", pa.float64()), ("n", pa.int64())]
                fields = pa.schema([batch.schema.field("doc_id"), ("n_chars", pa.int64()), *plain, *numbers])
            for doc, body, n, part, guest in rows_of([batch], "doc_id", "text", "n", "part", "guest"):
                body = body or ""
                found = fingerprint(body, k, window)
                if last is not None and last[3] == part:
                    if last[2] > 1:  # the next of all but one of equal rows is another of them
                        out.append(compared(last[0], last[1], last[4], last[1], last[4], last[2] - 1))
                    out.append(compared(last[0], last[1], last[4], body, found, 1))
                last = None if guest else (doc, body, n, part, found)
            yield from batches_of(iter(out), fields)

    return repeated(rows.mapInArrow(run, schema), "n")
