"""Toxic passages as segments of high token log-odds.

A token's score is its log-odds of standing in a toxic document, with a Dirichlet prior centred on the tokens that
share its beginning, which in turn has one centred on all documents. Scores are lowered so that a clean text's sum
falls; a linear scan then finds every maximal segment, and extreme-value statistics of clean texts say how likely a
segment of that sum is by chance in a text of that length. A document's segments add up to one expected number of
chance hits, from which a probability is fitted.
"""

from __future__ import annotations

import string
import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import rows_of, unused, utf8
from tidemark.session import staged

TRAIN_ROWS = 20_000  # labelled documents of each kind that are learnt from, at most
WORD_CELLS, HEAD_CELLS = 1 << 20, 1 << 16  # tables of counts; their size doesn't follow the input
HEAD = 4  # bytes of a token's beginning
STRENGTH = 10.0  # documents that a prior counts as
MARGIN = 1.0  # taken from every token's score
BIN, LIMIT = 0.05, 12.0  # of token scores
LIKELY = 0.01  # chance below which a passage is reported
EULER = 0.5772156649015329

LETTERS = bytes(c if c > 127 or chr(c) in string.ascii_letters else 32 for c in range(256)).lower()


class Model(NamedTuple):
    """Documents with a token, clean and toxic, by cell; documents; then what the calibration finds."""

    words: np.ndarray
    heads: np.ndarray
    docs: np.ndarray
    rate: float = 1.0  # decay of the chance of a sum
    shift: float = 0.0  # log of the number of places, per token
    fit: tuple[float, float] = (0.0, 0.0)

    @property
    def learnt(self) -> bool:
        return bool((self.docs > 0).all())


def tokens(text: str | None) -> list[bytes]:
    """Lower-case runs of letters; characters beyond ASCII count as letters."""
    return utf8(text).translate(LETTERS).split()


def cells(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    n = len(found)
    words = np.fromiter(map(zlib.crc32, found), np.int64, n) % WORD_CELLS
    heads = np.fromiter((zlib.crc32(t[:HEAD]) for t in found), np.int64, n) % HEAD_CELLS
    return words, heads


def token_scores(model: Model, words: np.ndarray, heads: np.ndarray, own: int | None = None) -> np.ndarray:
    """Scores of tokens; ``own`` is the label of a document that the counts hold, which is then left out."""
    less = np.zeros(2) if own is None else np.eye(2)[own]
    docs = np.maximum(model.docs - less, 0.5)
    base = docs[1] / docs.sum()
    head = np.maximum(model.heads[heads] - less, 0)
    centre = (head[:, 1] + STRENGTH * base) / (head.sum(axis=1) + STRENGTH)
    word = np.maximum(model.words[words] - less, 0)
    share = (word[:, 1] + STRENGTH * centre) / (word.sum(axis=1) + STRENGTH)
    odds = np.log(share / (1 - share)) - np.log(base / (1 - base))
    return np.clip(odds - MARGIN, -LIMIT, LIMIT)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal segments as ``(sum, first, last)``, by the linear scan of Ruzzo and Tompa."""
    sums = np.cumsum(scores)
    held: list[tuple[float, float, int, int]] = []  # sum before, sum with, first, last
    for k in np.flatnonzero(scores > 0):
        left, right, first, last = float(sums[k] - scores[k]), float(sums[k]), int(k), int(k)
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][0] >= left:
                j -= 1
            if j < 0 or held[j][1] >= right:
                held.append((left, right, first, last))
                break
            left, first = held[j][0], held[j][2]
            del held[j:]
    return [(right - left, first, last) for left, right, first, last in held]


def surprise(model: Model, found: list[tuple[float, int, int]], n: int) -> float:
    """Minus the log of the expected number of chance hits as good as the document's segments together."""
    sums = model.rate * np.array([s for s, _, _ in found] or [0.0])
    top = sums.max()
    return float(top + np.log(np.exp(sums - top).sum()) - np.log(max(n, 1)) - model.shift)


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _counted(training: DataFrame) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((1 + HEAD_CELLS + WORD_CELLS, 2), np.int64)
        for text, toxic in rows_of(batches, "text", "toxic"):
            words, heads = cells(list(set(tokens(text))))
            counts[0, toxic] += 1
            counts[1 + np.unique(heads), toxic] += 1
            counts[1 + HEAD_CELLS + np.unique(words), toxic] += 1
        there = np.flatnonzero(counts.any(axis=1))
        columns = (there, counts[there, 0], counts[there, 1])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "clean", "toxic"])

    found = training.mapInArrow(run, "cell bigint, clean bigint, toxic bigint").groupBy("cell").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    ).toArrow()
    counts = np.zeros((1 + HEAD_CELLS + WORD_CELLS, 2))
    counts[found["cell"].to_numpy()] = np.stack([found["clean"].to_numpy(), found["toxic"].to_numpy()], axis=1)
    return Model(counts[1 + HEAD_CELLS :].astype(np.float32), counts[1 : 1 + HEAD_CELLS].astype(np.float32), counts[0])


def _decay(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of ``sum(share * exp(rate * value)) = 1``, for values of negative mean."""
    if not (values[shares > 0] > 0).any():
        return 1.0
    low, high = 1e-6, 1.0
    while (shares * np.exp(high * values)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(middle * values)).sum() < 1 else (low, middle)
    return (low + high) / 2


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the log-odds of ``y``, with a small ridge; the slope is not negative."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 0.1 * beta
        hessian = (design * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ design + 0.1 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Learns from labelled documents that are not held out.

    Of each kind at most ``TRAIN_ROWS`` are used, by the hash of their ids; if a document has several labels, the
    largest counts. Labels of ids that no document has count for nothing, and rows equal in id and text count once. The
    ids of these are broadcast, the counts and the calibration's figures come to the driver; all are bounded by the
    parameters above. If documents of both kinds are not there, it warns and nothing is learnt. In the calibration a document's own counts are left out, and a document
    stands for as many as its kind has labels for each that is used, so a score means the same for any input size.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_hash"))
    marked = staged(rows.select("_id", "_hash").join(marked, "_id").distinct(), "marked")
    there = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    order = (F.xxhash64("_id"), "_id", "_hash")
    sample = marked.where("toxic = 0").orderBy(*order).limit(TRAIN_ROWS).union(marked.where("toxic = 1").orderBy(*order).limit(TRAIN_ROWS))
    found = rows.join(F.broadcast(sample), ["_id", "_hash"])
    training = staged(found.groupBy("_id", "_hash").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic"), "training")
    model = _counted(training)
    if not model.learnt:
        warnings.warn(f"nothing is learnt from {int(model.docs[0])} clean and {int(model.docs[1])} toxic documents", stacklevel=2)
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bins = int(2 * LIMIT / BIN) + 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(bins, np.int64)
        for (body,) in rows_of(batches, "text"):
            scores = token_scores(shared.value, *cells(tokens(body)), own=0)
            counts += np.bincount(np.rint((scores + LIMIT) / BIN).astype(np.int64), minlength=bins)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bins)), pa.array(counts)], names=["bin", "n"])

    clean = training.where("toxic = 0").mapInArrow(spread, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(bins)
    counts[clean["bin"].to_numpy()] = clean["n"].to_numpy()
    rate = _decay(np.arange(bins) * BIN - LIMIT, counts / max(counts.sum(), 1))
    model = model._replace(rate=rate)
    shared.unpersist()
    again = docs.sparkSession.sparkContext.broadcast(model)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, toxic in rows_of([batch], "text", "toxic"):
                scores = token_scores(again.value, *cells(tokens(body)), own=toxic)
                found = segments(scores)
                best = max((s for s, _, _ in found), default=0.0)
                out.append((toxic, again.value.rate * best - np.log(max(len(scores), 1)), surprise(again.value, found, len(scores))))
            columns = np.array(out).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(columns[:, k]) for k in range(3)], names=["toxic", "best", "surprise"])

    seen = training.mapInArrow(figures, "toxic double, best double, surprise double").toArrow()  # TRAIN_ROWS of each kind
    toxic, best, surprises = (seen[c].to_numpy() for c in ("toxic", "best", "surprise"))
    # The largest sum of a clean text is a Gumbel variable, whose mean lies Euler's constant above its mode.
    shift = float(best[toxic == 0].mean() - EULER)
    again.unpersist()
    stands_for = [max(there[k] / TRAIN_ROWS, 1.0) for k in (0, 1)]
    return model._replace(shift=shift, fit=_logistic(surprises - shift, toxic, np.where(toxic == 1, stands_for[1], stands_for[0])))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, score, passages``, one row per row of ``docs``.

    ``score`` is the fitted probability of the toxic label; ``passages`` are all segments that a clean text of that
    length has with a chance below ``LIKELY``, as first and last token (from 0) and sum. A null or empty text has no
    passage and the score of a text without evidence. If nothing could be learnt, for want of documents of both kinds,
    every score is 0. Rows that repeat an id have a row each. Whole texts are scored, however long. Other columns are
    not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "score", "passages"]
    schema = f"doc_id {kind}, text_hash bigint, score double, passages array<struct<first:int,last:int,sum:double>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("sum", pa.float64())])
        for batch in batches:
            values, passages = [], []
            for (body,) in rows_of([batch], "text"):
                found, n = [], 0
                if m.learnt:
                    scores = token_scores(m, *cells(tokens(body)))
                    found, n = segments(scores), len(scores)
                    x = m.fit[0] + m.fit[1] * surprise(m, found, n)
                    values.append(float(1 / (1 + np.exp(-np.clip(x, -30, 30)))))
                else:
                    values.append(0.0)
                # The chance of one hit or more, of which ``rare`` are expected, is 1 - exp(-rare).
                rare = [np.exp(min(np.log(max(n, 1)) + m.shift - m.rate * s, 50)) for s, _, _ in found]
                passages.append([{"first": a, "last": b, "sum": s} for r, (s, a, b) in zip(rare, found, strict=True) if -np.expm1(-r) < LIKELY])
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(values, pa.float64()), pa.array(passages, pa.list_(passage))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose score is ``least`` or more; all columns stay, whatever their names.

    Rows equal in id and text go or stay together, null ids too. Null and empty texts have the score of a text without
    evidence. An empty table gives no rows.
    """
    gone = score(docs, fit(docs, labels)).where(F.col("score") >= least)
    of_id, of_hash = unused(docs.columns, "of_id", "of_hash")
    gone = gone.select(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_hash)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_hash))
    return docs.join(gone, same, "left_anti")
