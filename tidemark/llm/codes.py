"""Compression of vectors to codes: each part of a vector becomes the number of the nearest codebook entry.

Components are whole numbers. A task takes its vectors a block at a time. The distinct parts of a block, in
lexicographic order, are the leaves of a trie whose levels are the part's components. The trie is walked depth
first, a run of leaves at a time: the distances of a prefix to all entries are accumulated once and shared by all
leaves below it, and the path to a run's last leaf goes on into the next run. A leaf takes the entry at the least
distance and, weighted by how many vectors have it, is added to that entry's sums. Only these sums are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.session import staged

UNIT = 256  # a component x becomes floor(UNIT * x)
BLOCK = 1 << 15  # vectors whose parts share a trie
RUN = 1 << 12  # leaves whose distances are held at once


class Codebooks(NamedTuple):
    """``entries`` by part, entry and position within the part."""

    entries: np.ndarray

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @property
    def sha256(self) -> str:
        """Of the decimal numbers of all entries in order, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def nearest(leaves: np.ndarray, entries: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each of the distinct, sorted ``leaves``; of equal distances the lowest entry.

    The trie of the leaves is walked depth first, ``run`` leaves at a time.
    """
    n, depth = leaves.shape
    which, least = np.empty(n, np.int64), np.empty(n, np.int64)
    # For every leaf, the first level at which its prefix is not that of the leaf before.
    fresh = np.zeros(n, np.int64)
    if n > 1:
        fresh[1:] = np.argmax(leaves[1:] != leaves[:-1], axis=1)
    path: list[np.ndarray] = []  # accumulated distances along the way to the last leaf of the run before
    for at in range(0, n, run):
        part, new = leaves[at : at + run], fresh[at : at + run]
        above, owner, after = None, None, []
        for level in range(depth):
            first = np.flatnonzero(new <= level)  # leaves that open a node of this level
            carried = not len(first) or first[0] != 0  # the node of the first leaf is the path's
            add = (part[first, level, None] - entries[None, :, level]) ** 2
            if above is not None:
                add += above[owner[first]]
            here = np.concatenate([path[level][None], add]) if carried else add
            owner = np.cumsum(new <= level) - (0 if carried else 1)
            above = here
            after.append(here[-1])
        which[at : at + run] = np.argmin(above, axis=1)[owner]
        least[at : at + run] = np.min(above, axis=1)[owner]
        path = after
    return which, least


def distinct_parts(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, each row's number among them, and how often each occurs."""
    order = np.lexsort(part.T[::-1])
    ordered = part[order]
    opens = np.append(True, np.any(ordered[1:] != ordered[:-1], axis=1))[: len(part)]
    number = np.empty(len(part), np.int64)
    number[order] = np.cumsum(opens) - 1
    return ordered[opens], number, np.bincount(number)


def _largest(dims: int) -> int:
    """Components stop here, so that a distance fits a long: two to the 27th for 64 of them."""
    return 1 << ((62 - max(dims - 1, 1).bit_length()) // 2 - 1)


def kept(df: DataFrame, parts: int, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, int]:
    """``vec_id, label, ints`` of the rows whose vector holds no null and nothing that is not finite, and the length of ``ints``.

    The length is that of the smallest id's vector which can be cut in ``parts``; vectors of other lengths have null
    ``ints``. It is 0 if there is none.
    """
    values = F.col("values")
    unfit = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("values"))
    rows = staged(rows.where(values.isNotNull() & ~unfit), "vectors")
    whole = rows.where((F.size(values) > 0) & (F.size(values) % parts == 0))
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), values).select(F.size(values)).head()
    dims = first[0] if first else 0
    most = float(_largest(dims))
    ints = F.transform(values, lambda x: F.floor(F.greatest(F.least(x * UNIT, F.lit(most)), F.lit(-most))).cast("int"))
    return rows.select("vec_id", "label", F.when((F.size(values) == dims) & (F.size(values) > 0), ints).alias("ints")), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(rows: DataFrame, books: Codebooks) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Count and sum of what is nearest to an entry, by part, entry and position; as many figures as ``books`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.entries.shape
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros(books.entries.shape, np.int64)
        held: list[np.ndarray] = []
        ended = False
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if not ended:
                held.append(_matrix(batch.column("ints"), books.dims))
            if held and (ended or sum(map(len, held)) >= BLOCK):
                block, held = np.concatenate(held), []
                for p in range(parts):
                    leaves, _, weight = distinct_parts(block[:, p * width : (p + 1) * width])
                    which, _ = nearest(leaves, books.entries[p])
                    np.add.at(counts[p], which, weight)
                    np.add.at(sums[p], which, leaves * weight[:, None])
        used = np.argwhere(np.repeat(counts[:, :, None], width, axis=2) > 0)
        columns = [*used.T, counts[used[:, 0], used[:, 1]], sums[tuple(used.T)]]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names=["p", "e", "i", "n", "total"])

    found = rows.mapInArrow(run, "p bigint, e bigint, i bigint, n bigint, total bigint").groupBy("p", "e", "i")
    found = found.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r["p"], r["e"], r["i"]): (r["n"], int(r["total"])) for r in found.collect()}


def fit(rows: DataFrame, dims: int, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks of all ``rows`` of ``kept``: they start from the ``entries`` smallest ids, and follow ``rounds`` of means.

    Rows that repeat an id count in the order of their components; null ids come last. With fewer rows there are
    fewer entries.
    """
    rows = rows.where(F.col("ints").isNotNull()).select("vec_id", "ints")
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    width = dims // parts
    books = Codebooks(np.array([r["ints"] for r in seeds], np.int64).reshape(len(seeds), parts, width).swapaxes(0, 1))
    for _ in range(rounds):
        entry = books.entries.copy()
        for (p, e, i), (n, total) in _sums(rows, books).items():
            entry[p, e, i] = total // n  # floors
        books = Codebooks(entry)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every row of ``kept``; ``code`` is an array with each part's entry."""
    kind = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(n, kind[n]) for n in ("vec_id", "label")]).add("code", T.ArrayType(T.IntegerType())).add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books.dims // books.parts
        for batch in batches:
            ints = batch.column("ints")
            there = np.flatnonzero(ints.is_valid().to_numpy(zero_copy_only=False))
            block = _matrix(ints.drop_null(), books.dims)
            code, error = np.empty((len(block), books.parts), np.int32), np.zeros(len(block), np.int64)
            for p in range(books.parts if len(block) else 0):
                leaves, number, _ = distinct_parts(block[:, p * width : (p + 1) * width])
                which, least = nearest(leaves, books.entries[p])
                code[:, p] = which[number]
                error += least[number]
            # Rows without whole parts take a place past the end, which gives null.
            place = np.full(batch.num_rows, -1, np.int64)
            place[there] = np.arange(len(there))
            place = pa.array(place, mask=place < 0)
            lists = pa.ListArray.from_arrays(np.arange(0, code.size + 1, books.parts, dtype=np.int32), pa.array(code.ravel()))
            columns = [batch.column("vec_id"), batch.column("label"), lists.take(place), pa.array(error).take(place)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def hex_code(code: Column) -> Column:
    """Two hexadecimal digits for each part."""
    return F.lower(F.array_join(F.transform(code, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def compress(
    df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256``, one row per row that is kept.

    Rows go whose vector is null or holds a null or a component that is not finite. ``error`` is the squared distance
    of all parts, ``label_error`` its sum over the rows of the label (null is a label). Rows that repeat an id have a
    row each. A vector that is empty, or of another length than the smallest id's which can be cut, has a null code
    and error. Components are exact to ``_largest``, about half a million for 64 of them, and stop there, so a
    distance always fits. Other columns are not read. An empty table gives no rows. Up to 256 entries are allowed.
    """
    if not 0 < entries <= 256 or parts < 1:
        raise ValueError("a code has two digits for each part")
    rows, dims = kept(df, parts, key, vector, label)
    books = fit(rows, dims, parts, entries, rounds) if dims else Codebooks(np.zeros((parts, 0, 1), np.int64))
    if dims:
        coded = staged(encode(rows, books), "codes")
    else:
        coded = rows.select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
    # One row per label, so a label with very many rows is split by the adaptive join.
    sums = staged(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "label", hex_code(F.col("code")).alias("code"), "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
