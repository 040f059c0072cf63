"""Queries that apply the operators of this folder to whole tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import align, codes, mixing, near, packing, rules, sharding, simhash, spans, sql, toxicity, urls, warc, winnow
from tidemark.llm.common import table

URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)
TOXIC_FROM = 0.3
SHARDS = tuple(f"shard-{k:02d}" for k in range(64))


def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = near.near_duplicates(table(spark, sf, "documents"), width=3, percent=85)
    return found.select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), "component_id", "kept")


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    found = mixing.mix(table(spark, sf, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), *tokenizer())


def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    index = warc.write_bundles(table(spark, sf, "pages"), warc.archive_folder(spark))
    return warc.read_bundles(index)


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    entries = rules.ledger(table(spark, sf, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"), rules.passes(rules.STANDARD).alias("kept"), "failed",
    )


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return found.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )


def op8_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.with_shard(table(spark, sf, "documents").select("doc_id"), SHARDS)


def op9_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return winnow.compare_edited(table(spark, sf, "documents"))


def op10_sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))


def op11_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    found = codes.compress(table(spark, sf, "embeddings"), parts=16, entries=64, rounds=2)
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align.align(table(spark, sf, "documents"), *tokenizer_files())


def tokenizer_files() -> tuple[str, str, str]:
    """The 50k byte-level vocabulary as ranks and its pattern, and a model of pieces; the tests compare the ids with those of ``tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


def tokenizer() -> tuple[str, str, dict[str, int]]:
    """The 50k byte-level vocabulary as ranks, its pattern and added tokens; the tests compare its ids with those of ``tokenizers``."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_near_duplicates, op3_mixing, op4_packing, op5_warc,
        op6_quality_rules, op7_toxicity, op8_shards, op9_winnowing, op10_sentence_spans,
        op11_simhash, op12_vector_codes, op13_token_alignment,
    )
}
# The others draw, learn, tokenize or hash; the tests hold them against plain Python.
SQL = {
    "op1_url_filter": sql.url_filter(URL_RULES),
    "op2_near_duplicates": sql.near_duplicates(3, 85),
    "op5_warc": sql.warc(),
    "op6_quality_rules": sql.quality_rules(),
    "op8_shards": sql.shards(SHARDS),
    "op12_vector_codes": sql.vector_codes(16, 64, 2),
}
