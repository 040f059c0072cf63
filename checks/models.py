"""Splitting, training, measuring."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.tables import PROFILES, STOPS, VALENCES, WEIGHTS, headlines, rounded, table
from checks.texts import ETL
from tidemark.operators import evaluate, rows, vectors
from tidemark.plans import headlines as plans, training
from tidemark.session import new_folder


def split_rows(spark, sf):
    training_rows, validation_rows = rows.split_rows(table(spark, sf, "documents").select("doc_id"), "doc_id")
    return rows.union_all(
        [
            training_rows.withColumn("side", F.lit("training")),
            validation_rows.withColumn("side", F.lit("validation")),
        ]
    )


def _judged(spark, sf):
    """Quality as the label and toxicity as the guess."""
    return table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def confusion_counts(spark, sf):
    return evaluate.confusion(_judged(spark, sf))


def confusion_metrics(spark, sf):
    found = evaluate.metrics(evaluate.confusion(_judged(spark, sf)))
    return found.select(F.round("f1", 8).alias("f1"), F.round("accuracy", 8).alias("accuracy"))


def cleaned_rows(spark, sf):
    cleaned = plans.clean_headlines(headlines(spark, sf), STOPS, PROFILES, VALENCES, WEIGHTS, "en")
    return cleaned.select("id", "title_clean", "score", "num_comments", "polarity", "subjectivity")


def tokenizer_words(spark, sf):
    """The tokens the model sees."""
    [tokenizer] = [s for s in training.build_pipeline().getStages() if isinstance(s, Tokenizer)]
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("title_clean"))
    return tokenizer.transform(docs).select("doc_id", F.array_join("words", "|").alias("words"))


def hashed_terms(spark, sf):
    """Hashed term counts add up to the tokens of a document."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("title_clean"))
    tokenizer, _, hashing = training.build_pipeline().getStages()[:3]
    slots = hashing.transform(tokenizer.transform(docs)).select("doc_id", F.explode(vector_to_array("word_counts")).alias("n"))
    return slots.groupBy("doc_id").agg(F.sum("n").cast("bigint").alias("terms"))


def _hashed(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("title_clean"))
    tokenizer, _, hashing = training.build_pipeline().getStages()[:3]
    return hashing.transform(tokenizer.transform(docs))


def hashed_slots(spark, sf):
    """How often each slot of a document is hit."""
    slots = _hashed(spark, sf).select("doc_id", F.posexplode(vector_to_array("word_counts")).alias("slot", "n"))
    return slots.where("n > 0").select("doc_id", "slot", F.col("n").cast("bigint").alias("n"))


def slot_idf(spark, sf):
    """The fitted weight of every slot."""
    model = training.build_pipeline().getStages()[3].fit(_hashed(spark, sf))
    found = [(k, int(n), float(w)) for k, (n, w) in enumerate(zip(model.docFreq, model.idf.toArray(), strict=True))]
    return rounded(spark.createDataFrame(found, "slot int, doc_freq bigint, idf double"), 8, "idf")


_TRAINED: dict[tuple[str, str], training.Trained] = {}


def trained(spark, sf):
    """One training per application and tables; the other queries of the model read it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = training.train(cleaned_rows(spark, sf), "id")
    return _TRAINED[key]


def train_predict(spark, sf):
    return trained(spark, sf).predictions.select("id", "label", "prediction")


def train_metrics(spark, sf):
    return trained(spark, sf).metrics


def validation_labels(spark, sf):
    """The rows held back and their labels."""
    return trained(spark, sf).predictions.select("id", F.col("label").cast("int").alias("label"))


def assembled_numbers(spark, sf):
    """What the classifier reads: how many numbers, and the three that are neither word vector nor term weight."""
    features = vector_to_array("features")
    numbers = [features[training.VECTOR_SIZE + k].alias(n) for k, n in enumerate(("score", "num_comments", "subjectivity"))]
    found = trained(spark, sf).predictions.select("id", F.size(features).alias("n"), *numbers)
    return rounded(found, 6, "score", "num_comments", "subjectivity")


def loaded_model_agrees(spark, sf):
    """Whether a saved and loaded model predicts what the trained one does."""
    path, found = new_folder(spark, "saved-model"), trained(spark, sf)
    training.save_model(found.model, path)
    inputs = found.predictions.select("id", "title_clean", "score", "num_comments", "subjectivity", "label")
    again = training.load_model(path).transform(inputs).select("id", F.col("prediction").alias("again"))
    return found.predictions.join(again, "id").select("id", (F.col("prediction") == F.col("again")).alias("agrees"))


def train_other(spark, sf):
    """Another classifier, with word vectors from counts."""
    stage = vectors.CountVectors("words", "headline_vector", training.VECTOR_SIZE, min_count=5, rounds=4)
    found = training.train(cleaned_rows(spark, sf), "id", word_vectors=stage, classifier=LogisticRegression(maxIter=20))
    return found.predictions.select("id", F.col("label").cast("int").alias("label"), F.col("prediction").isin(0.0, 1.0, 2.0).alias("a_class"))


QUERIES = {
    f.__name__: f
    for f in (
        split_rows, confusion_counts, confusion_metrics, tokenizer_words, hashed_terms, hashed_slots, slot_idf,
        train_predict, train_metrics, validation_labels, assembled_numbers, loaded_model_agrees, train_other,
    )
}

_JUDGED = "SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels"

# The tokenizer splits at each white space character and drops empty tokens at the end.
_MODEL_WORDS = r"""
    SELECT doc_id, regexp_split_to_array(regexp_replace(lower(text), '[ \t\n\v\f\r]+$', ''), '[ \t\n\v\f\r]') AS words
    FROM documents
"""

_LOW = "& 4294967295"


def _turned(x: str, by: int) -> str:
    return f"(((({x}) << {by}) {_LOW}) | (({x}) >> {32 - by}))"


def _block(k: str) -> str:
    """What a block of four bytes adds to a hash."""
    return f"(({_turned(f'(({k}) * 3432918353::UBIGINT) {_LOW}', 15)} * 461845907::UBIGINT) {_LOW})"


def _last(h: str, shift: int, times: int | None) -> str:
    mixed = f"xor({h}, ({h}) >> {shift})"
    return f"(({mixed} * {times}::UBIGINT) {_LOW})" if times else mixed


# MurmurHash3 of a word's bytes with the seed 42 as a signed number, modulo the slots.
_SLOTS = f"""
    words AS (SELECT doc_id, unnest(words) AS word FROM ({_MODEL_WORDS})),
    bytes AS (SELECT word, hex(encode(word)) AS hexed, octet_length(encode(word)) AS size FROM (SELECT DISTINCT word FROM words)),
    numbers AS (SELECT word, size, list_transform(range(size), lambda k: CAST('0x' || substr(hexed, 2 * k + 1, 2) AS UBIGINT)) AS b FROM bytes),
    blocks AS (
        SELECT word, size, list_transform(range(size // 4), lambda k: b[4 * k + 1] + 256 * b[4 * k + 2] + 65536 * b[4 * k + 3] + 16777216 * b[4 * k + 4]) AS blocks,
               CAST(coalesce(b[size // 4 * 4 + 1], 0) + 256 * coalesce(b[size // 4 * 4 + 2], 0) + 65536 * coalesce(b[size // 4 * 4 + 3], 0) AS UBIGINT) AS tail
        FROM numbers
    ),
    bodies AS (
        SELECT word, size, tail, list_reduce(list_prepend(42::UBIGINT, list_transform(blocks, lambda k: CAST({_block('k')} AS UBIGINT))),
               lambda h, k: CAST(({_turned('xor(h, k)', 13)} * 5 + 3864292196::UBIGINT) {_LOW} AS UBIGINT)) AS h
        FROM blocks
    ),
    ends AS (SELECT word, xor(xor(h, {_block('tail')}), CAST(size AS UBIGINT)) AS h FROM bodies),
    one AS (SELECT word, {_last('h', 16, 2246822507)} AS h FROM ends),
    two AS (SELECT word, {_last('h', 13, 3266489909)} AS h FROM one),
    hashes AS (SELECT word, CAST({_last('h', 16, None)} AS BIGINT) AS h FROM two),
    slots AS (SELECT word, CAST(((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 100 + 100) % 100 AS INTEGER) AS slot FROM hashes),
    hits AS (SELECT doc_id, slot, count(*) AS n FROM words JOIN slots USING (word) GROUP BY 1, 2)
"""
_HELD_BACK = "CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 4 = 0"

SQL = {
    "hashed_slots": f"WITH {_SLOTS} SELECT doc_id, slot, n FROM hits",
    "slot_idf": f"""
        WITH {_SLOTS},
        f AS (SELECT CAST(k AS INTEGER) AS slot, count(doc_id) AS doc_freq FROM range(100) r(k) LEFT JOIN hits ON slot = k GROUP BY 1)
        SELECT slot, doc_freq, CASE WHEN doc_freq >= 5 THEN round(ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (doc_freq + 1)), 8) + 0.0 ELSE 0::DOUBLE END AS idf FROM f
    """,
    "validation_labels": f"""{ETL}
        SELECT id, CASE WHEN polarity > 0.05 THEN 2 WHEN polarity < -0.05 THEN 0 ELSE 1 END AS label FROM c WHERE {_HELD_BACK}
    """,
    "assembled_numbers": f"""{ETL}
        SELECT id, {training.VECTOR_SIZE + 3 + training.TERM_SLOTS} AS n, CAST(c.score AS DOUBLE) AS score, CAST(id AS DOUBLE) AS num_comments,
               round(subjectivity, 6) + 0.0 AS subjectivity FROM c WHERE {_HELD_BACK}
    """,
    "loaded_model_agrees": f"{ETL} SELECT id, true AS agrees FROM c WHERE {_HELD_BACK}",
    "train_other": f"""{ETL}
        SELECT id, CASE WHEN polarity > 0.05 THEN 2 WHEN polarity < -0.05 THEN 0 ELSE 1 END AS label, true AS a_class FROM c WHERE {_HELD_BACK}
    """,
    "tokenizer_words": f"SELECT doc_id, array_to_string(words, '|') AS words FROM ({_MODEL_WORDS})",
    "hashed_terms": f"SELECT doc_id, len(words) AS terms FROM ({_MODEL_WORDS})",
    "split_rows": """
        SELECT doc_id, CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4 = 0
                            THEN 'validation' ELSE 'training' END AS side
        FROM documents
    """,
    "confusion_counts": f"SELECT label, prediction, count(*) AS n FROM ({_JUDGED}) GROUP BY 1, 2",
    "confusion_metrics": f"""
        WITH j AS ({_JUDGED}),
        c AS (SELECT label AS cls FROM j UNION SELECT prediction FROM j),
        m AS (SELECT cls, count(*) FILTER (WHERE label = cls) AS actual, count(*) FILTER (WHERE prediction = cls) AS said,
                     count(*) FILTER (WHERE label = cls AND prediction = cls) AS hits
              FROM c, j GROUP BY cls)
        SELECT round(sum(CASE WHEN actual + said = 0 THEN 0 ELSE 2::DOUBLE * hits / (actual + said) END * actual) / sum(actual), 8) AS f1,
               round(sum(hits) / sum(actual)::DOUBLE, 8) AS accuracy
        FROM m
    """,
}
