"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words. A document is to be taken ``target / source size`` times; the whole
part is certain, and the fractions of a source's documents are rounded against each other: of two documents with a
fraction, one gives words to the other until a fraction is 0 or 1, at random but with unchanged expectations. So a
source's words stay put while its documents become whole. Blocks of documents are rounded each in one task, which
leaves one fraction; these are combined through a tree of further rounds until a source has one left.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.common import repeated, word_count
from tidemark.session import staged

BLOCK = 1_000  # documents that a task rounds against each other
FAN_IN = 64  # blocks whose last fractions the next round combines


def ranked(names: DataFrame, name: str) -> DataFrame:
    """Adds ``rank``, from 0, to distinct names by code point, null last.

    Names are range-partitioned and numbered inside their range; a table with one row per range shifts the numbers.
    """
    order = F.col(name).asc_nulls_last()
    at = F.monotonically_increasing_id()  # range number in the upper bits, row in the lower 33
    ranged = staged(names.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", at), "ranks")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    rank = F.col("_start") + F.col("_at").bitwiseAND(2**33 - 1)
    return ranged.join(starts, "_part").withColumn("rank", rank).drop("_part", "_at", "_start")


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Adds ``target`` to ``rank, source_size``.

    Sources share ``share`` times all words by ``weights``, repeated along the ranks. A target stops at ``most`` times
    the source's size and what is left is shared again by weight among the others, until none is above.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = staged(sources.withColumns({"_weight": weight, "_cap": F.col("source_size") * float(most)}), "sources")
    total = share * (rows.agg(F.sum("source_size")).head()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_weight") * level
        taken, count, left = rows.agg(
            F.sum(F.when(full, F.col("_cap"))), F.count_if(full), F.sum(F.when(~full, F.col("_weight")))
        ).head()
        if count == capped or not left:
            break
        capped, level = count, (total - (taken or 0.0)) / left
    return rows.withColumn("target", F.least("_cap", F.col("_weight") * level)).drop("_weight", "_cap")


def pivotal(sizes: np.ndarray, fractions: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Fractions after pairwise rounding; all but at most one of those with a size are then 0 or 1.

    The running document and the next one exchange ``sizes * fractions``; ``draws`` are uniform in [0, 1).
    """
    after, edge = fractions.copy(), 1e-12
    last = -1
    for k in range(len(after)):
        if after[k] <= edge or after[k] >= 1 - edge:
            after[k] = round(after[k])
            continue
        if last < 0:
            last = k
            continue
        i, j = last, k
        # Words that may move from i to j and back before one of the two fractions is whole.
        there = min(after[i] * sizes[i], (1 - after[j]) * sizes[j])
        back = min((1 - after[i]) * sizes[i], after[j] * sizes[j])
        moved = -there if draws[k] * (there + back) < back else back
        after[i] += moved / sizes[i]
        after[j] -= moved / sizes[j]
        last = -1
        for m in (i, j):
            if edge < after[m] < 1 - edge:
                last = m
            else:
                after[m] = round(after[m])
    return after


def _rounded(rows: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool, seed: int) -> DataFrame:
    """Rounds the groups of ``keys``; in the ``last`` round what is left is decided by its fraction alone."""
    schema = T.StructType([f for f in rows.schema if f.name not in ("fraction", "copies", "open")])
    schema = schema.add("fraction", "double").add("copies", "long").add("open", "boolean")

    def run(group: pa.Table) -> pa.Table:
        # Arrow keeps ids as they are; pandas would make them doubles beside a null.
        group = group.take(pc.sort_indices(group, sort_keys=[(k, "ascending") for k in order], null_placement="at_end"))
        place = xxhash.xxh3_64_intdigest(repr([group.column(k)[0].as_py() for k in keys]).encode(), seed=seed)
        draws = np.random.Generator(np.random.PCG64(place)).random(len(group) + 1)
        sizes, fractions = (group.column(c).to_numpy().astype(np.float64) for c in ("size", "fraction"))
        after = pivotal(sizes, fractions, draws[:-1])
        open_ = (after > 0) & (after < 1)
        if last:
            after = np.where(open_, (draws[-1] < after).astype(float), after)
            open_ = np.zeros(len(after), bool)
        copies = group.column("whole").to_numpy() + np.where(open_, 0, after).astype(np.int64)
        new = {"fraction": pa.array(after), "copies": pa.array(copies), "open": pa.array(open_)}
        return pa.table({f.name: new[f.name] if f.name in new else group.column(f.name) for f in schema})

    return rows.groupBy(*keys).applyInArrow(run, schema)


def _chosen(rows: DataFrame, weights: Sequence[int], share: float, most: float, seed: int) -> DataFrame:
    """Equal rows of ``doc_id, text_hash, source, size`` and what else there is, once, with ``n``, ``source_size``, ``target`` and ``copies``.

    ``n`` is how often the row is there and ``copies`` how often the mix takes all of them together: equal rows are one
    unit that is rounded once, however many they are.
    """
    keys = rows.columns
    rows = staged(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    sums = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("rows"))
    plan = staged(targets(ranked(sums, "source"), weights, share, most), "targets")
    # One row per source, so a source with very many documents is split by the adaptive join.
    same = rows["source"].eqNullSafe(plan["source"])
    placed = rows.join(plan, same).drop(plan["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = rate * F.col("n")
    whole = F.floor(wanted + F.lit(1e-12))
    blocks = F.ceil(F.col("rows") / BLOCK)
    placed = placed.withColumns(
        {
            "whole": F.when(F.col("size") > 0, whole).otherwise(F.when(rate > 0, F.col("n")).otherwise(0)).cast("bigint"),
            "fraction": F.when(F.col("size") > 0, F.greatest(wanted - whole, F.lit(0.0))).otherwise(F.lit(0.0)),
            "block": F.pmod(F.xxhash64("doc_id", "text_hash"), blocks).cast("bigint"),
        }
    ).drop("rows")
    order = ("doc_id", "text_hash", "size", *(k for k in keys if k == "other"))
    level = staged(_rounded(placed, ("rank", "block"), order, False, seed), "rounded")
    done = [level.where(~F.col("open"))]
    blocks = plan.agg(F.max(F.ceil(F.col("rows") / BLOCK))).head()[0] or 0
    while True:
        seed += 1
        last = blocks <= FAN_IN
        left = level.where("open").withColumn("block", F.floor(F.col("block") / FAN_IN).cast("bigint"))
        level = staged(_rounded(left, ("rank", "block"), order, last, seed), "rounded")
        done.append(level.where(~F.col("open")))
        if last:
            break
        blocks = -(-blocks // FAN_IN)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(*keys, "n", "source_size", "target", "copies")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id, text_hash, source, size, source_size, target, copies, taken``, one row per row of ``docs``.

    ``size`` counts words, a null text has none; ``target`` is that of the document's source (null is a source of its
    own), ``copies`` the times the document is taken and ``taken`` the words of these. No document is taken more than
    ``most`` times, rounded up. A document without words is taken once if its source is taken at all. A source's words
    miss its target by at most its largest document. The draws depend on ids, sizes and ``seed`` alone, so a
    rerun gives the same mix. Rows with equal id, text and source are rounded together and share their copies as evenly
    as whole copies can be shared; ids are kept as they are, null ones too. Very long texts are only counted. Other
    columns are not read. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    )
    each, over = F.floor(F.col("copies") / F.col("n")), F.col("copies") % F.col("n")
    dealt = F.array(F.struct(over.alias("n"), (each + 1).alias("copies")), F.struct((F.col("n") - over).alias("n"), each.alias("copies")))
    found = _chosen(rows, weights, share, most, seed).withColumn("dealt", F.explode(dealt))
    found = repeated(found.withColumns({"n": F.col("dealt.n"), "copies": F.col("dealt.copies")}), "n")
    return found.select(
        "doc_id", "text_hash", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; all columns stay, whatever their names.

    Rows that are equal in all columns are rounded together, and one of them stands for all that are taken. Null ids,
    null, empty and very long texts are rows like any other, as :func:`mix` says. An empty table gives no rows.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        whole.alias("row"), F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(source).alias("source"), F.xxhash64(whole).alias("other"), word_count(F.col(text)).alias("size")
    )
    chosen = staged(_chosen(rows.drop("row"), weights, share, most, seed).where("copies > 0"), "chosen")
    of = chosen.select(*[F.col(c).alias(f"of_{c}") for c in ("doc_id", "text_hash", "source", "other")], "n", "copies")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("doc_id", "source")] + [F.col(c) == F.col(f"of_{c}") for c in ("text_hash", "other")]
    joined = rows.join(of, same)
    taken = joined.select("row", "n", "copies")
    if not chosen.where("n > 1").isEmpty():
        # Equal rows meet in each task first, so a row that is there very often is not gathered.
        again = joined.where("n > 1").groupBy("doc_id", "text_hash", "source", "other").agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
        taken = taken.where("n = 1").drop("n").unionByName(again.select("row", "copies"))
    return repeated(taken.select("row", "copies"), "copies").select("row.*")
