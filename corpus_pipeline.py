"""Documents to training sequences: toxicity, near and substring duplicates, source weights, packing.

Each stage reads the documents that the one before has kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import mixing, near, packing, queries, spans, toxicity
from tidemark.llm.common import table
from tidemark.session import staged

# No stage can be expressed in SQL: models, sketches, draws and token ids are compared with plain Python in the tests.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), queries.TOXIC_FROM)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    return near.without_near_duplicates(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated passages go; ``n_chars`` follows the text. Every document's row stays."""
    cleaned = spans.remove_repeats(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document's row is there as often as the mix takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of 1024 tokens; a row that is there twice is packed twice, null texts too."""
    return packing.pack(docs, *queries.tokenizer())


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_dedup),
    ("substring_duplicates", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
