"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; policies,
which name the rules they enforce, are applied to the bits later, and what a rule alone removes is counted from sums
over equal ledgers, without a text being read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import rows_of, utf8

SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\v\f\r"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_marks", "longest_word",
)


class Rule(NamedTuple):
    name: str
    fails: str  # SQL over the measures


# A rule's place is its bit. Rules are only ever added at the end, so old ledgers and policies stay valid.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("few_distinct_words", "100 * n_distinct_words < 10 * n_words"),
    Rule("marks", "100 * n_marks > 50 * n_words"),
    Rule("endless_word", "longest_word > 1000"),
)


class Policy(NamedTuple):
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self) -> int:
        names = [r.name for r in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))


def measured(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``; all 0 for a null or empty text."""
    raw = utf8(text)
    words = raw.split()
    if not words:
        return (0,) * len(MEASURES)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    return (
        len(words),
        len(text) - sum(map(text.count, GAPS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids, len(numbers)),
        len(lines),
        len(numbers),
        text.count("!") + text.count("?"),
        max(map(len, words)),
    )


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words that lie in a window of three words which the text has at least twice."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * kinds + ids[1:]
    if kinds > 2_000_000:  # else three numbers fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, counts = np.unique(pairs[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True)
    often = counts[at] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : k + len(often)] |= often
    return int(inside.sum())


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the measures and ``failed`` (bits of failed rules), one row per row of ``docs``.

    A null or empty text has no words, all measures 0. Rows that repeat an id have a row each. Other columns are not
    read; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for name in MEASURES:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measured(t) for (t,) in rows_of([batch], "text")], np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(found[:, k]) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    bits = F.lit(0).cast("bigint")
    for k, rule in enumerate(RULES):
        bits = bits + F.when(F.expr(rule.fails), 1 << k).otherwise(0)
    return rows.mapInArrow(run, schema).withColumn("failed", bits)


def passes(policy: Policy, failed: str = "failed") -> Column:
    """Whether a ledger's bits satisfy the policy."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask()).cast("bigint")) == 0


def ablations(entries: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """``policy, version, rule, failing, only, kept_without``: what each rule of a policy does.

    Equal bits are counted once, so all policies and rules share one aggregate of at most 2^rules rows. ``failing``
    documents break the rule, ``only`` break no other of the policy, ``kept_without`` pass if it is left out.
    """
    bits = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    out = []
    names = [r.name for r in RULES]
    for policy in policies:
        mask = F.lit(policy.mask()).cast("bigint")
        left = F.col("failed").bitwiseAND(mask)
        for rule in policy.rules:
            bit = 1 << names.index(rule)
            rest = F.col("failed").bitwiseAND(F.lit(policy.mask() & ~bit).cast("bigint"))
            out += [
                F.struct(
                    F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.lit(rule).alias("rule"),
                    F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(bit).cast("bigint")) != 0, F.col("n"))), F.lit(0)).alias("failing"),
                    F.coalesce(F.sum(F.when(left == bit, F.col("n"))), F.lit(0)).alias("only"),
                    F.coalesce(F.sum(F.when(rest == 0, F.col("n"))), F.lit(0)).alias("kept_without"),
                )
            ]
    return bits.agg(F.array(*out).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
