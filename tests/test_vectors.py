"""Word vectors from counts against plain Python and numpy."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import vectors

TEXTS = ["a b a c", "b c d a b", "d d a", "", "e", "a c e b d a e c", "b b b a"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t.split()) for k, t in enumerate(TEXTS)] + [(90, None), (91, ["a", None, "b"])]
    return spark.createDataFrame(rows, "id int, words array<string>").repartition(3)


def plain_counts(window):
    found = Counter()
    for words in [t.split() for t in TEXTS] + [["a", None, "b"]]:
        for i, a in enumerate(words):
            for b in words[i + 1 : i + 1 + window]:
                if a and b:
                    found[a, b] += 1
                    found[b, a] += 1
    return found


@pytest.mark.parametrize("window", [1, 2, 5])
def test_cooccurrences(docs, window):
    got = {(r["word"], r["context"]): r["n"] for r in vectors.cooccurrences(docs, "words", window).collect()}
    assert got == plain_counts(window)


def test_rare_words_are_left_out(docs):
    kept = {"a", "b"}  # nine and eight times
    got = {(r["word"], r["context"]): r["n"] for r in vectors.cooccurrences(docs, "words", 2, 8).collect()}
    assert got == {p: n for p, n in plain_counts(2).items() if set(p) <= kept}


@pytest.mark.parametrize("most", [0, 1, 1000])
def test_known_words_may_be_too_many_to_broadcast(docs, monkeypatch, most):
    kept = {"a", "b", "c", "d"}  # "e" occurs three times
    monkeypatch.setattr(vectors, "MAX_WORDS", most)
    got = {(r["word"], r["context"]): r["n"] for r in vectors.cooccurrences(docs, "words", 3, 4).collect()}
    assert got == {p: n for p, n in plain_counts(3).items() if set(p) <= kept}


def plans_of_staged(monkeypatch):
    plans, run = {}, vectors.staged

    def spied(df, name="staged"):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return run(df, name)

    monkeypatch.setattr(vectors, "staged", spied)
    return plans


def test_pairs_and_their_information_are_counted_without_a_shuffle_by_word(spark, docs, monkeypatch):
    plans = plans_of_staged(monkeypatch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # words of more than these bytes
        values = vectors.ppmi(vectors.cooccurrences(docs, "words", 2, 2))
        plan = values._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plans["cooccurrences"] + plan and "lambda" not in plans["cooccurrences"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_round_shuffles_no_entries(spark, monkeypatch):
    plans = plans_of_staged(monkeypatch)
    m = np.arange(25.0).reshape(5, 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        vectors.leading_vectors(matrix_frame(spark, m + m.T), 2, extra=2, rounds=2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plans["subspace"] and plans["subspace"].count("hashpartitioning") == 1


def plain_ppmi(window):
    counts = plain_counts(window)
    names = sorted({w for w, _ in counts})
    c = np.array([[counts[a, b] for b in names] for a in names], float)
    with np.errstate(divide="ignore"):
        return names, np.maximum(np.log(c * c.sum() / np.outer(c.sum(1), c.sum(0))), 0)


def test_ppmi(docs):
    names, want = plain_ppmi(2)
    got = {(r["word"], r["context"]): r["value"] for r in vectors.ppmi(vectors.cooccurrences(docs, "words", 2)).collect()}
    assert got == pytest.approx({(a, b): want[i, j] for i, a in enumerate(names) for j, b in enumerate(names) if want[i, j] > 0})


def matrix_frame(spark, m):
    rows = [(f"w{i:02d}", f"w{j:02d}", float(m[i, j])) for i in range(len(m)) for j in range(len(m)) if m[i, j]]
    return spark.createDataFrame(rows, "word string, context string, value double")


def plain_vectors(m, size):
    values, axes = np.linalg.eigh(m)
    order = np.argsort(-np.abs(values))[:size]
    return axes[:, order] * np.sqrt(np.abs(values[order]))


@pytest.mark.parametrize("threshold", [None, "-1"])
def test_leading_vectors_are_those_of_numpy(spark, threshold):
    rng = np.random.default_rng(6)
    axes, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    m = axes @ np.diag([9.0, -7.5, 6.0, 4.0, *np.linspace(1.5, 0, 26)]) @ axes.T
    if threshold:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = vectors.leading_vectors(matrix_frame(spark, (m + m.T) / 2), 4, extra=3, rounds=20).orderBy("word").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got, want = np.array([r["vector"] for r in rows]), plain_vectors((m + m.T) / 2, 4)
    for j in range(4):
        assert (got[:, j] ** 3).sum() >= 0
        sign = np.sign(got[:, j] @ want[:, j])
        np.testing.assert_allclose(got[:, j], sign * want[:, j], atol=1e-5)


def test_fewer_directions_than_asked_for(spark):
    m = np.outer([1.0, 2, 3, 4], [1.0, 2, 3, 4])
    rows = vectors.leading_vectors(matrix_frame(spark, m), 3, extra=2, rounds=6).orderBy("word").collect()
    got = np.array([r["vector"] for r in rows])
    np.testing.assert_allclose(got[:, 0], [1, 2, 3, 4], atol=1e-6)
    np.testing.assert_allclose(got[:, 1:], 0, atol=1e-4)


def test_an_empty_table_has_no_vectors(spark, docs):
    assert vectors.word_vectors(docs.where("false"), "words", 2, rounds=2).collect() == []


def test_mean_vectors_are_those_of_the_library(spark, docs):
    known = vectors.word_vectors(docs.where("id < 90"), "words", 2, 2, rounds=8)
    table = {r["word"]: np.array(r["vector"]) for r in known.collect()}
    assert set(table) == set("abcde")
    got = {r["id"]: r["vector"] for r in vectors.mean_vectors(docs, "id", "words", known.where("word <> 'e'"), 2).collect()}
    table["e"] = np.zeros(2)
    for k, text in enumerate(TEXTS):
        words = text.split()
        want = sum((table[w] for w in words), np.zeros(2)) / max(len(words), 1)
        np.testing.assert_allclose(got[k], want, atol=1e-12)
    assert got[90] == [0.0, 0.0]

    stage = vectors.CountVectors("words", "v", 2, 2, rounds=8)
    model = stage.fit(docs.where("id < 90"))
    from pyspark.ml.functions import vector_to_array

    rows = model.transform(docs.where("id < 7")).select("id", vector_to_array("v").alias("v")).collect()
    whole = {r["id"]: r["vector"] for r in vectors.mean_vectors(docs, "id", "words", known, 2).collect()}
    for r in rows:
        np.testing.assert_allclose(r["v"], whole[r["id"]], atol=1e-6)
    with pytest.raises(ValueError, match="words"):
        vectors.CountVectors("words", "v", 2, max_words=3, rounds=2).fit(docs.where("id < 90"))


def test_vectors_tell_groups_of_words_apart(spark):
    """Words of two subjects that never share a text."""
    rng = np.random.default_rng(1)
    subjects = [[f"{s}{k}" for k in range(12)] for s in "xy"]
    texts = [(k, list(rng.choice(subjects[k % 2], 8))) for k in range(400)]
    df = spark.createDataFrame(texts, "id int, words array<string>")
    found = {r["word"]: np.array(r["vector"]) for r in vectors.word_vectors(df, "words", 2, rounds=8).collect()}
    middle = [np.mean([found[w] for w in s], axis=0) for s in subjects]
    assert all(np.linalg.norm(found[w] - middle[k]) < np.linalg.norm(found[w] - middle[1 - k]) for k, s in enumerate(subjects) for w in s)


def test_a_pipeline_takes_the_stage(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    from tidemark.plans import training

    cleaned = spark.range(300).select(
        "id",
        F.when(F.col("id") % 3 == 0, "good win today").when(F.col("id") % 3 == 1, "bad loss today").otherwise("plain day").alias("title_clean"),
        F.col("id").alias("score"), (F.col("id") % 7).alias("num_comments"), F.lit(0.5).alias("subjectivity"),
        F.when(F.col("id") % 3 == 0, 0.6).when(F.col("id") % 3 == 1, -0.6).otherwise(0.0).alias("polarity"),
    )
    stage = vectors.CountVectors("words", "headline_vector", 3, rounds=6)
    trained = training.train(cleaned, "id", word_vectors=stage, classifier=LogisticRegression(maxIter=20))
    assert trained.metrics.head()["accuracy"] > 0.95
    training.save_model(trained.model, str(tmp_path / "m"))
    again = training.load_model(str(tmp_path / "m")).transform(trained.predictions.select("id", "title_clean", "score", "num_comments", "subjectivity", "label"))
    both = again.select("id", F.col("prediction").alias("p")).join(trained.predictions, "id")
    assert both.where("p <> prediction").isEmpty() and both.count() > 0
