"""Near duplicates by SimHash with a multi-index.

A fingerprint has 64 bits, cut in two segments. Of two fingerprints that differ in three bits or fewer, one segment
differs in one bit at most. So each fingerprint is entered in a table under both its segments, and looks up there every
value of the small Hamming ball around its own segments; what it finds is verified on all bits.

Equal fingerprints are one entry. The members of a table's bucket, entered there or looking in, are compared inside
tasks, block by block, and a task gives back only links that join components; pairs are never written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import rows_of, utf8
from tidemark.llm.links import components
from tidemark.session import staged

SEED = 42  # of the shingles' hashes
SEGMENTS, BITS = 2, 32
BLOCK = 1_000  # members of a bucket that a task compares with as many others


def fingerprint(text: str | None, width: int = 3, seed: int = SEED) -> int:
    """A bit is 1 if over half of the hashes of the text's shingles, repeats included, have it; none give 0."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(width, len(words)) - 1 :]
    first = np.append(0, ends[:-1] + 1)[: len(last)]
    ones, step = np.zeros(64, np.int64), 1 << 16  # hashes whose bits are counted at once
    for k in range(0, len(last), step):
        spans = zip(first[k : k + step].tolist(), last[k : k + step].tolist(), strict=True)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, bits``: the fingerprint of every row as a signed number."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("bits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, width) for (t,) in rows_of([batch], "text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _segment(number: int) -> Column:
    return F.shiftrightunsigned("bits", BITS * number).bitwiseAND(2**BITS - 1)


def _table(nodes: DataFrame) -> DataFrame:
    """``bucket, bits``: each fingerprint under both its segments."""
    own = F.array(*[_segment(k).bitwiseOR(F.lit(k << BITS)) for k in range(SEGMENTS)])
    return nodes.select(F.explode(own).alias("bucket"), "bits")


def _looked_up(nodes: DataFrame) -> DataFrame:
    """``bucket, bits``: the buckets one bit away from each fingerprint's segments.

    Only values above its own: of two segments one bit apart the smaller one looks for the larger one.
    """
    ball = F.array(*[_segment(k).bitwiseOR(F.lit(k << BITS | 1 << b)) for k in range(SEGMENTS) for b in range(BITS)])
    own = F.array(*[_segment(k).bitwiseOR(F.lit(k << BITS)) for k in range(SEGMENTS)])
    return nodes.select(F.explode(F.array_except(ball, own)).alias("bucket"), "bits")


def _hashed(per_key: DataFrame) -> DataFrame:
    """A table with a row per key, to be joined by shuffles and hashed in each task: the driver gets none of it."""
    return per_key.hint("shuffle_hash")


def joining_links(bits: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of ``left`` with ``right`` members at ``most`` bits that join components, as places in ``bits``."""
    unsigned = bits.view(np.uint64)  # signed numbers are counted without their sign
    labels, found, others = np.arange(len(bits)), [], unsigned[right]
    for i in left:
        near = right[np.bitwise_count(others ^ unsigned[i]) <= most]
        for label in np.unique(labels[near]):
            if label != labels[i]:
                found.append((i, near[labels[near] == label][0]))
                labels[labels == label] = labels[i]
    return found


def _links(table: DataFrame, seeking: DataFrame, most: int) -> DataFrame:
    """``a, b``: links between members of a bucket, of which at least one is entered there.

    ``table`` has one row per bucket and entered member, ``seeking`` one per bucket and member that looks in. A large
    bucket's members are dealt to blocks, and a task compares two of them.
    """
    entered = staged(table.groupBy("bucket").agg(F.count(F.lit(1)).alias("entered")), "buckets")
    # Spark sizes ``seeking`` as the rows it is exploded from, and so might broadcast it.
    hits = staged(seeking.join(_hashed(entered), "bucket"), "hits")
    sought = hits.groupBy("bucket").agg(F.count(F.lit(1)).alias("sought"))
    sizes = entered.join(_hashed(sought), "bucket", "left").na.fill(0, ["sought"]).where("entered + sought > 1")
    members = table.withColumn("inside", F.lit(True)).unionByName(hits.select("bucket", "bits", F.lit(False).alias("inside")))
    inner, outer = F.ceil(F.col("entered") / BLOCK), F.ceil(F.col("sought") / BLOCK)
    hashed = F.xxhash64("bits")
    own = F.when(F.col("inside"), F.pmod(hashed, inner)).otherwise(inner + F.pmod(hashed, outer))
    last = F.when(F.col("inside"), inner + outer).otherwise(inner) - 1
    dealt = members.join(_hashed(staged(sizes, "sizes")), "bucket").select("bucket", "bits", "inside", own.cast("int").alias("own"), last.cast("int").alias("last"))
    dealt = dealt.select("bucket", "bits", "inside", "own", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    pair = ("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    dealt = dealt.select(*pair, (F.col("own") <= F.col("other")).alias("first"), "bits")
    dealt = dealt.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bucket", "one", "two", "first", "bits")
        held = [np.empty(0, t) for t in (np.int64, np.int32, np.int32, bool, np.int64)]
        ended = False
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if batch is not None:
                more = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
                held = [np.append(h, m) for h, m in zip(held, more, strict=True)]
            *place, first, bits = held
            change = np.any([p[1:] != p[:-1] for p in place], axis=0) if len(bits) else np.empty(0, bool)
            starts = np.append(0, np.flatnonzero(change) + 1)
            # The last group may go on in the next batch; two blocks at most are held.
            stop = len(bits) if ended else starts[-1]
            ends = np.append(starts[1:], len(bits))
            found = []
            for a, b in zip(starts[ends <= stop].tolist(), ends[ends <= stop].tolist(), strict=True):
                if b - a > 1:
                    left, right = np.flatnonzero(first[a:b]), np.arange(b - a)
                    if held[1][a] != held[2][a]:
                        right = np.flatnonzero(~first[a:b])
                    found += [(bits[a + i], bits[a + j]) for i, j in joining_links(bits[a:b], left, right, most)]
            held = [h[stop:] for h in held]
            columns = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, bits, fingerprint, component_id``, one row per row of ``docs``.

    Rows are linked if their fingerprints differ in ``most`` bits or fewer, three at most; ``component_id`` is the
    smallest id reachable. ``fingerprint`` are the bits as 16 hexadecimal digits. A-Z are lower-cased; a text with
    fewer than ``width`` words is one shingle. Null and empty texts and those without words have the fingerprint
    zero and are linked like any other. A null id is never the smallest while there is another. Rows that repeat an
    id have a row each. Whole texts are read, a very long one's hashes in parts. Other columns, whatever their
    names, are not read. An empty table gives no rows.
    """
    if not 0 <= most <= 2 * SEGMENTS - 1:
        raise ValueError("two segments find fingerprints that differ in three bits at most")
    found = staged(fingerprints(docs, width, key, text), "fingerprints")
    nodes = staged(found.groupBy("bits").agg(F.min("doc_id").alias("low_id")), "nodes")
    labels = components(staged(_links(_table(nodes), _looked_up(nodes), most), "links")).withColumnRenamed("node", "bits")
    lows = nodes.join(_hashed(labels), "bits").groupBy("label").agg(F.min("low_id").alias("least"))
    # Staged, for its true size: a large component's rows are not gathered by label if a row per component can be sent to each.
    owned = labels.join(staged(lows, "lows"), "label")
    owners = nodes.join(_hashed(owned), "bits", "left").select("bits", F.coalesce("least", "low_id").alias("component_id"))
    digits = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return found.join(_hashed(staged(owners, "owners")), "bits").select("doc_id", "bits", digits, "component_id")
