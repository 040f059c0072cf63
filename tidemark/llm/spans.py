"""Substring dedup by sliding spans of sentences.

Sentences are cut further where their words say so, alike wherever a passage stands. Every short run of consecutive
pieces is hashed. A run that other documents have too is kept in the first of them alone: the pieces of any other
occurrence go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import rows_of, unused
from tidemark.llm.shingles import STEP, mixed
from tidemark.session import staged

SPAN_SENTENCES, SPAN_WORDS = 2, 20  # a run has at least so many
LAST = 1 << 62  # where rows without an id of their own begin
WINDOW = 10  # so many words in a row have a cut among them; 3 * WINDOW + SPAN_WORDS - 1 repeated words always hold a run

INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))
END = re.compile(r"[.!?]+[\"')\]]*\s+|\n\s*")
GAPS = np.zeros(256, bool)
GAPS[[32, *range(9, 14)]] = True  # the bytes that ``common.GAP`` names


class Pieces(NamedTuple):
    """A text cut in pieces, as places in its bytes, and the words of each piece."""

    raw: bytes
    ends: np.ndarray
    words: np.ndarray
    hashes: np.ndarray


def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the parts ``first`` to ``last`` (not included) of ``values``, the same wherever a part stands.

    A part's hash is the difference of two prefixes of a polynomial in STEP, divided by its first power.
    """
    n = len(values)
    power, inverse = (np.cumprod(np.append(np.uint64(1), np.full(n, x, np.uint64)), dtype=np.uint64) for x in (STEP, INVERSE))
    prefix = np.append(np.uint64(0), np.cumsum(values * power[:n], dtype=np.uint64))
    return (prefix[last] - prefix[first]) * inverse[first]


def _picked(values: np.ndarray) -> np.ndarray:
    """Where the rightmost smallest value of any ``WINDOW`` values in a row stands."""
    n = len(values)
    if n < WINDOW:
        return np.empty(0, np.int64)
    low = values << np.uint64(32) | np.arange(n, 0, -1, dtype=np.uint64)  # a later place is smaller
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        low, width = np.minimum(low[:-step], low[step:]), width + step
    return np.unique(n - (low & np.uint64(0xFFFFFFFF)).astype(np.int64))


def cut(text: str | None) -> Pieces:
    """Sentences with the gap after them, cut further where the words say so.

    A word's hash is its rank, and the word at a sentence's start ranks first. Of any ``WINDOW`` words in a row the
    least is cut before, so what is more than ``WINDOW`` words inside a repeated passage is cut alike in every text.
    """
    raw = (text or "").encode()
    low = np.frombuffer(raw.lower(), np.uint8)
    n = len(low)
    if not n:
        return Pieces(raw, *(np.empty(0, t) for t in (np.int64, np.int64, np.uint64)))
    ends = np.array([m.end() for m in END.finditer(text)], np.int64)
    if len(text) < n:
        ends = np.append(np.flatnonzero(low & 0xC0 != 0x80), n)[ends]
    ends = np.append(ends, n) if not len(ends) or ends[-1] < n else ends
    # Words start and end with a change of kind, and where a sentence ends at a gap that is none of GAPS.
    gap = np.concatenate([[True], GAPS[low], [True]])
    inside = ends[~(gap[ends] | gap[ends + 1])]
    first = np.flatnonzero(gap[:-1] & ~gap[1:])
    last = np.flatnonzero(~gap[:-1] & gap[1:])
    if len(inside):
        first, last = np.sort(np.append(first, inside)), np.sort(np.append(last, inside))
    if len(first):
        words = mixed(_sums(low.astype(np.uint64) + np.uint64(1), first, last))
        sentence = np.searchsorted(ends, first, side="right")
        opens = np.append(True, sentence[1:] != sentence[:-1])
        picked = _picked(np.where(opens, np.uint64(0), (words >> np.uint64(33)) + np.uint64(1)))
        picked = picked[~opens[picked]]
        if len(picked):
            ends = np.sort(np.append(ends, first[picked]))
        upto = np.append(0, np.searchsorted(first, ends))
        hashes = mixed(_sums(words, upto[:-1], upto[1:]))
    else:
        upto, hashes = np.zeros(len(ends) + 1, np.int64), np.zeros(len(ends), np.uint64)
    return Pieces(raw, ends, np.diff(upto), hashes)


def sentences(text: str | None) -> list[str]:
    """The text in the pieces that make it up."""
    found = cut(text)
    return [found.raw[a:b].decode() for a, b in zip([0, *found.ends[:-1]], found.ends, strict=False)]


def runs(pieces: Pieces, least: int = SPAN_SENTENCES, words: int = SPAN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first and last piece of all runs.

    From each piece the shortest run with ``least`` pieces and ``words`` words goes forward, and the shortest
    goes back, so a repeated passage is covered to both its ends. Case of A-Z and gaps don't count; a piece without
    words counts as none of the pieces.
    """
    number = np.flatnonzero(pieces.words)
    n = len(number)
    if n < least:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    upto = np.append(0, np.cumsum(pieces.words[number]))
    first = np.arange(n)
    forward = np.maximum(np.searchsorted(upto, upto[:-1] + words), first + least)  # one past the last
    back = np.minimum(np.searchsorted(upto, upto[1:] - words, side="right") - 1, first + 1 - least)
    # Each pair as one number; a text has fewer than 2^31 pieces.
    pairs = np.unique(np.concatenate([(first << 32 | forward)[forward <= n], (back << 32 | first + 1)[back >= 0]]))
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    found = mixed(_sums(pieces.hashes[number], a, b) ^ (b - a).astype(np.uint64))
    return found, number[a], number[b - 1]


def _again(hashes: np.ndarray) -> np.ndarray:
    """Whether a hash has occurred before."""
    seen = np.ones(len(hashes), bool)
    seen[np.unique(hashes, return_index=True)[1]] = False
    return seen


def cleaned(text: str | None, gone: np.ndarray) -> tuple[str | None, int, int]:
    """The text without pieces covered by a run in ``gone`` or by a run's second occurrence in this text.

    Also the number of pieces and of those removed. A null text stays null.
    """
    pieces = cut(text)
    n = len(pieces.ends)
    hashes, first, last = runs(pieces)
    removed = np.zeros(n + 1, np.int64)
    drop = _again(hashes) | np.isin(hashes, gone)
    np.add.at(removed, first[drop], 1)
    np.add.at(removed, last[drop] + 1, -1)
    covered = np.cumsum(removed)[:n] > 0
    if not covered.any():
        return text, n, 0
    starts = np.append(0, pieces.ends[:-1])
    kept = b"".join(pieces.raw[a:b] for a, b in zip(starts[~covered].tolist(), pieces.ends[~covered].tolist(), strict=True))
    return kept.decode(), n, int(covered.sum())


def placed(docs: DataFrame, name: str, key: str, text: str) -> DataFrame:
    """Adds the column ``name``, a number that orders documents and tells them apart: the id where one row alone has it.

    Rows whose id is null, repeated or no whole number come last, in the order of a hash of id and text.
    """
    told = F.shiftrightunsigned(F.xxhash64(key, text), 2).bitwiseOR(F.lit(LAST))
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        return docs.withColumn(name, told)
    own = F.col(key).cast("bigint")
    (of,) = unused([*docs.columns, name], "of")
    again = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(of)).agg(F.count(F.lit(1)).alias("rows"))
    again = staged(again.where("rows > 1").select(of), "repeated-ids")
    if again.isEmpty():
        return docs.withColumn(name, F.when(F.col(key).isNull(), told).otherwise(own))
    joined = docs.join(again, F.col(key) == F.col(of), "left")
    return joined.withColumn(name, F.when(F.col(key).isNull() | F.col(of).isNotNull(), told).otherwise(own)).drop(of)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` cleaned, and the columns ``n_sentences`` and ``n_removed``; one row per row.

    The first occurrence of a run is that in the smallest id, there the first; the others' pieces go. Rows whose id
    is null, repeated or no whole number come after all others, in the order of a hash of id and text; rows equal in
    both count as one document and stay alike. A document may be left without text; its row stays, the text empty. Null
    and empty texts stay as they are, very long ones are read whole. Columns named like the new ones are replaced, all
    others stay, whatever their names. An empty table gives no rows.

    Only hashes and ids are shuffled to find repeats. Equal hashes of a task are summed before the shuffle, and
    the join that follows splits a run which very many documents have.
    """
    place_name, gone_name = unused(docs.columns, "place", "gone")
    docs = placed(docs, place_name, key, text)
    rows = docs.select(F.col(place_name).alias("_id"), F.col(text).alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for doc, body in rows_of([batch], "_id", "_text"):
                hashes = np.unique(runs(cut(body))[0])
                found.append(hashes.view(np.int64))
                ids.append(np.full(len(hashes), doc))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(ids).astype(np.int64))], names=["_span", "_id"])

    spans = staged(rows.mapInArrow(hashed, "_span bigint, _id bigint"), "spans")
    firsts = spans.groupBy("_span").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where("_first < _last")
    gone = spans.join(firsts.select("_span", "_first"), "_span").where("_id > _first")
    gone = gone.groupBy(F.col("_id").alias(place_name)).agg(F.collect_set("_span").alias(gone_name))  # a document's own runs
    others = [c for c in docs.columns if c not in ("n_sentences", "n_removed", place_name)]
    joined = docs.join(gone, place_name, "left").select(*[F.col(f"`{c}`") for c in others], gone_name)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", n_sentences bigint, n_removed bigint"
    place = others.index(text)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [cleaned(t, np.array(g or [], np.int64).view(np.uint64)) for t, g in rows_of([batch], text, gone_name)]
            texts, counts, removed = zip(*out, strict=True) if out else ((), (), ())
            columns = [batch.column(c) for c in others]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*others, "n_sentences", "n_removed"])

    return joined.mapInArrow(rewrite, schema)
