"""Near-duplicate documents by HyperMinHash.

Every text's set of word shingles is kept as 128 compressed registers. Equal sets are one node. Bands of
registers bring candidates together; their similarity is estimated from all registers, corrected for agreement
by chance, and what may be similar enough is confirmed on the full sets. Documents are linked in components.

A bucket's members are not paired with each other. First each is compared with the bucket's smallest and
largest node. Then only members that are still in different components are compared, block by block inside
tasks: by their estimates, and those that may be similar enough on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import groups_of, unused
from tidemark.llm.links import components
from tidemark.llm.shingles import (
    EMPTY,
    REGISTERS,
    bands,
    estimates,
    lowest_estimate,
    registers,
    rows_per_band,
    shingle_set,
)
from tidemark.session import staged

BLOCK = 1000  # members of one bucket that a task compares with as many others


def sketches(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_shingles, node, sketch`` of every row.

    ``node`` is the 64-bit hash of the set, null for a text without words.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", id_type)]
        + [T.StructField(n, T.LongType()) for n in ("text_hash", "n_shingles", "node")]
        + [T.StructField("sketch", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, found = [], [], []
            for t in batch.column("text").to_pylist():
                hashes = shingle_set(t, width)
                sizes.append(len(hashes))
                nodes.append(xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63) if len(hashes) else None)
                found.append(registers(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(found, pa.binary())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def _registers(column: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


def _matrix(column: pa.Array) -> np.ndarray:
    return _registers(column.to_pylist())


def _banded(nodes: DataFrame, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = bands(_matrix(batch.column("sketch")), rows)
                node = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(keys.ravel())], names=["node", "band"])

    return nodes.select("node", "sketch").mapInArrow(run, "node bigint, band bigint")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sizes and sketches allow the similarity."""
    for side in ("a", "b"):
        of = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"of_{side}"))
        pairs = pairs.join(of, side)
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = _matrix(batch.column("of_a")), _matrix(batch.column("of_b"))
                there = ((one != EMPTY) | (other != EMPTY)).sum(axis=1)
                fit = estimates(one, other) >= lowest_estimate(percent / 100, there)
                yield batch.select(["a", "b"]).filter(pa.array(fit))

    return pairs.where(100 * low >= percent * high).select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    for side in ("b", "a"):  # last the smaller node, which may be that of very many pairs
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, np.empty(0, np.uint64)
        for batch in batches:
            fit = []
            for a, text_a, text_b in zip(*(batch.column(n).to_pylist() for n in ("a", "text_a", "text_b")), strict=True):
                if a != last:
                    last, one = a, shingle_set(text_a, width)
                other = shingle_set(text_b, width)
                both = len(np.intersect1d(one, other, assume_unique=True))
                fit.append(100 * both >= percent * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def _star(members: DataFrame) -> DataFrame:
    """Each member with the smallest and the largest node of its bucket."""
    ends = F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("node").alias("b")), F.struct(F.col("node").alias("a"), F.col("high").alias("b"))))
    return members.select(ends.alias("p")).select("p.*").where("a <> b").distinct()


def _across(members: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between members of a bucket that are still in different components, estimated and confirmed on the full sets.

    The component with the most members in a bucket is only compared with the others. Members are dealt to
    blocks, and a task compares two blocks by their sketches; a bucket whose members are all in one component has none.
    Only members that may be similar to one of another component go on, and their texts are joined to these alone. What
    a task gives back in the end are links that join components, fewer than it has members.
    """
    placed = members.where("n > 3").join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    sizes = placed.groupBy("band", "label").agg(F.count(F.lit(1)).alias("size"))
    buckets = sizes.groupBy("band").agg(
        F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("labels")
    ).where("labels > 1")
    blocks = {"minor_blocks": F.ceil((F.col("all") - F.col("top.size")) / BLOCK), "major_blocks": F.ceil(F.col("top.size") / BLOCK)}
    dealt = placed.join(buckets, "band").withColumns(blocks)
    hashed, small = F.xxhash64("node"), F.col("all") <= BLOCK
    minor = F.col("label") != F.col("top.label")
    own = F.when(small, 0).when(minor, F.pmod(hashed, F.col("minor_blocks"))).otherwise(F.col("minor_blocks") + F.pmod(hashed, F.col("major_blocks"))).cast("int")
    last = F.when(small, 0).when(minor, F.col("minor_blocks") + F.col("major_blocks") - 1).otherwise(F.col("minor_blocks") - 1).cast("int")
    other = F.explode(F.sequence(F.lit(0), "last"))
    dealt = dealt.select("band", "node", "label", minor.alias("minor"), own.alias("own"), last.alias("last"))
    dealt = dealt.select("band", "node", "label", "minor", "own", other.alias("other")).join(nodes.select("node", "sketch"), "node")
    pair = (F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    dealt = dealt.select("band", *pair, "node", "label", (F.col("minor") & (F.col("own") <= F.col("other"))).alias("left"), (F.col("own") >= F.col("other")).alias("right"), "sketch")
    dealt = dealt.repartition("band", "one", "two").sortWithinPartitions("band", "one", "two", "node")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "band", "one", "two"):
            labels = group.column("label").to_numpy()
            left, right = (np.flatnonzero(group.column(c).to_numpy(zero_copy_only=False)) for c in ("left", "right"))
            if not len(left) or (labels == labels[0]).all():
                continue
            lefts, rights = with_likely(_matrix(group.column("sketch")), labels, left, right, percent)
            if len(lefts):
                sides = np.zeros((2, len(labels)), bool)
                sides[0, lefts], sides[1, rights] = True, True
                columns = [*(group.column(c) for c in ("band", "one", "two", "node", "label")), *map(pa.array, sides)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "left", "right"]).filter(pa.array(sides.any(axis=0)))

    names = ("band", "one", "two", "node", "label")
    schema = "band bigint, one int, two int, node bigint, label bigint, left boolean, right boolean"
    asked = staged(dealt.mapInArrow(likely, schema), "asked")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        node, labels = (group[c].to_numpy() for c in ("node", "label"))
        left, right = (np.flatnonzero(group[c]) for c in ("left", "right"))
        found = joining_links([shingle_set(t, width) for t in group["text"]], labels.copy(), left, right, percent)
        return pd.DataFrame([(node[i], node[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return asked.join(texts.select("node", "text"), "node").groupBy("band", "one", "two").applyInPandas(run, "a bigint, b bigint").distinct()


def with_likely(
    sketch: np.ndarray, labels: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """The members of both sides that may be similar to one of another label on the other side, by their sketches."""
    many, of = sketch[right], labels[right]
    lefts, rights = np.zeros(len(left), bool), np.zeros(len(right), bool)
    for k, i in enumerate(left):
        there = ((many != EMPTY) | (sketch[i] != EMPTY)).sum(axis=1)
        fit = (estimates(sketch[i], many) >= lowest_estimate(percent / 100, there)) & (of != labels[i])
        lefts[k] = fit.any()
        rights |= fit
    return left[lefts], right[rights]


def joining_links(sets: list[np.ndarray], labels: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of ``left`` with ``right`` members that join different labels; joined labels become one as they are found.

    The right sets are turned into lists of members by hash, so one pass over a left set's hashes counts what it
    shares with every right member.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(every := np.concatenate([sets[j] for j in right] or [np.empty(0, np.uint64)]), kind="stable")
    owner, (hashes, starts) = owner[order], np.unique(every[order], return_index=True)
    starts = np.append(starts, len(every))
    found = []
    for i in left:
        if not len(hashes) or (labels[right] == labels[i]).all():
            continue
        at = np.searchsorted(hashes, sets[i])
        at = at[(at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == sets[i])]
        counts = starts[at + 1] - starts[at]
        places = np.repeat(starts[at] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(owner[places], minlength=len(right))
        near = right[100 * both >= percent * (sizes[right] + sizes[i] - both)]
        for j in near:
            if labels[j] != labels[i]:
                found.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return found


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``width``-word shingles;
    ``component_id`` is the smallest id reachable and ``kept`` marks the document of that id. A text without words
    has an empty set and is linked with nothing. Rows that repeat an id are told apart by ``text_hash``
    (``xxhash64`` of the text); a null id is never the smallest while there is another, else the row is kept.
    Other columns are not read. Whole texts are read, very long ones too. An empty table gives no rows.

    A pair of just that similarity shares no band in less than one of a million cases.
    """
    return _grouped(docs, width, percent, key, text).drop("group")


def _grouped(docs: DataFrame, width: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of :func:`near_duplicates` with ``group``, a number of each component; null for a text without words."""
    found = staged(sketches(docs, width, key, text), "sketches")
    full = found.where(F.col("node").isNotNull())
    nodes = staged(
        full.groupBy("node").agg(
            F.min("doc_id").alias("low_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"), F.min("n_shingles").alias("n"), F.first("sketch").alias("sketch")
        ),
        "nodes",
    )
    banded = _banded(nodes, rows_per_band(percent / 100))
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
    members = staged(banded.join(buckets.where("n > 1"), "band"), "members")

    texts = staged(_texts(docs, members.select("node").distinct().join(nodes, "node"), key, text), "texts")
    stars = _likely(_star(members), nodes, percent)
    near = staged(_confirmed(stars, texts, width, percent), "links")
    labels = components(near)
    more = staged(_across(members, labels, nodes, texts, width, percent), "links")
    labels = components(near.union(more))

    lows = labels.join(nodes.select("node", "low_id"), "node").groupBy("label").agg(F.min("low_id").alias("least"))
    owners = nodes.select("node", "low_id").join(labels.join(lows, "label"), "node", "left")
    owners = owners.select("node", F.coalesce("label", "node").alias("group"), F.coalesce("least", "low_id").alias("component_id"))
    result = found.join(owners, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return result.select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"), "group")


def _texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``node, text``: one document's text for each wanted node."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    ids = wanted.select("node", F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_hash"))
    same = rows["doc_id"].eqNullSafe(ids["_id"]) & (rows["text_hash"] == ids["_hash"])
    return rows.join(ids, same).groupBy("node").agg(F.first("text").alias("text"))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates; all columns stay, whatever their names.

    It is the row of the smallest id, among several of these the one of the least text hash, among rows equal in both
    the least by all columns. Null ids come last. Rows without words are in no group and all stay. An empty table gives
    no rows.
    """
    found = staged(_grouped(docs, width, percent).select("doc_id", "text_hash", "group", "kept"), "groups")
    gone = found.where(~F.col("kept")).select("doc_id", "text_hash")
    kept = found.where(F.col("kept") & F.col("group").isNotNull())
    # More than one row of a group has its smallest id only if ids are null or repeat.
    ties = staged(kept.groupBy("group").agg(F.count(F.lit(1)).alias("rows"), F.min("text_hash").alias("least")).where("rows > 1"), "ties")
    if ties.isEmpty():
        return _without(docs, gone.distinct())
    tied = kept.join(ties, "group")
    gone = gone.union(tied.where("text_hash <> least").select("doc_id", "text_hash"))
    equal = tied.where("text_hash = least").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    equal = staged(equal.where("rows > 1").select("doc_id", "text_hash"), "equal")
    of_id, of_hash = unused(docs.columns, "of_id", "of_hash")
    pairs = equal.select(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_hash))
    # Equal rows meet in each task first, so a row that is there very often is not gathered.
    once = docs.join(pairs, _same(of_id, of_hash)).groupBy(of_id, of_hash).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return _without(docs, gone.union(equal).distinct()).union(once.select("row.*"))


def _same(of_id: str, of_hash: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_hash))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows of the given ids and text hashes."""
    of_id, of_hash = unused(docs.columns, "of_id", "of_hash")
    pairs = gone.select(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_hash))
    return docs.join(pairs, _same(of_id, of_hash), "left_anti")
