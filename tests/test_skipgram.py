"""Skip-grams against plain Python."""

import heapq
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import skipgram
from tidemark.operators.wordtable import WordTable
from tidemark.plans import training

TEXTS = ["a b a c", "b c d a b", "d d a", "", "e", "a c e b d a e c", "b b b a"]


@pytest.mark.parametrize("counts", [[1], [1, 1], [5, 1], [1, 1, 1, 2, 3, 5, 8, 13], [2] * 7, [1] * 5 + [4] * 3 + [100], [3] * 6 + [7] * 2 + [1]])
def test_code_lengths_are_huffmans(counts):
    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        heapq.heappush(heap, both := heapq.heappop(heap) + heapq.heappop(heap))
        cost += both
    lengths = [length for length, n in skipgram.code_lengths(list(Counter(counts).items())) for _ in range(n)]
    assert sum(a * b for a, b in zip(sorted(counts, reverse=True), lengths, strict=True)) == cost
    assert sum(2.0**-length for length in lengths) == 1


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t.split()) for k, t in enumerate(TEXTS)] + [(90, None), (91, ["a", None, "b"]), (91, ["a", None, "b"])]
    return spark.createDataFrame(rows, "id int, words array<string>").repartition(3)


def test_leaves_end_all_paths(docs):
    counted = docs.select(F.explode("words").alias("word")).where("word IS NOT NULL").select("word", F.lit(1).cast("bigint").alias("n"))
    leaves = {r["word"]: r["key"] for r in skipgram.vocabulary(counted, 1).collect()}
    assert set(leaves) == set("abcde") and sum(2.0 ** (1 - k.bit_length()) for k in leaves.values()) == 1
    assert not any(a != b and bin(a).startswith(bin(b)) for a in leaves.values() for b in leaves.values())
    assert leaves["a"].bit_length() == min(k.bit_length() for k in leaves.values())
    assert {r["word"] for r in skipgram.vocabulary(counted, 4).collect()} == {"a", "b", "c", "d"}


def plain(rows, leaf, vectors, random, window, rate, rounds):
    """One word after the other; the products of a word are taken before it changes anything."""
    vectors, nodes = {w: np.array(v, float) for w, v in vectors.items()}, {}
    places = [(k, i) for k, words in enumerate(rows) for i in range(len(words))]
    for n, (k, i) in enumerate(places):
        width, pace = random.integers(1, window + 1, 1)[0], rate * (1 - n / len(places) / rounds)
        key = leaf[rows[k][i]]
        path = [(key >> up, 1 - (key >> (up - 1) & 1)) for up in range(key.bit_length() - 1, 0, -1)]
        change = []
        for j in range(max(i - width, 0), min(i + width + 1, len(rows[k]))):
            x = vectors[rows[k][j]]
            for node, wanted in path if j != i else []:
                u = nodes.setdefault(node, np.zeros(len(x)))
                error = wanted - 1 / (1 + np.exp(-(x @ u)))
                change += [(x, pace * error * u), (u, pace * error * x)]
        for to, by in [(to, by.copy()) for to, by in change]:
            to += by
    return vectors, nodes


def test_a_block_learns_what_plain_python_does(monkeypatch):
    for name, value in (("LEAST_STEP", 1), ("MOST_STEP", 1), ("MOST_GRADIENTS", 1000)):
        monkeypatch.setattr(skipgram, name, value)
    rows = [t.split() for t in TEXTS * 20]
    leaf = {"a": 2, "b": 6, "c": 14, "d": 30, "e": 31}
    first = {w: np.random.default_rng(k).random(3) - 0.5 for k, w in enumerate("abcde")}
    state = pa.table({"word": list(leaf), "key": pa.array(leaf.values(), pa.int64()), "x": pa.array([list(first[w]) for w in leaf], pa.list_(pa.float32()))})
    table = pa.table({"_order": list(range(len(rows))), "words": pa.array(rows, pa.list_(pa.string()))}).take(list(range(len(rows)))[::-1])
    got = skipgram._learnt("words", 3, 5, 7, 0, 2, 0.5)((pa.scalar(4),), table, state).to_pylist()
    vectors, nodes = plain(rows, leaf, first, np.random.default_rng([7, 0, 4]), 5, 0.5, 2)
    want = {leaf[w]: v for w, v in vectors.items()} | nodes
    assert {r["key"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        np.testing.assert_allclose(r["x"], want[r["key"]], atol=2e-3)
    assert max(np.abs(vectors[w] - first[w]).max() for w in "abcd") > 0.2


def test_all_words_are_fitted_and_again_alike(docs, monkeypatch):
    monkeypatch.setattr(skipgram, "FIT_TOKENS", 10)

    def fit(df, least=0):
        model = skipgram.SkipGram("words", "v", 3, min_count=least, tasks=2)._fit(df)
        assert isinstance(model, WordTable)
        return {r["word"]: r["vector"] for r in model.vectors.collect()}

    found = fit(docs)
    assert set(found) == set("abcde") and np.isfinite(list(found.values())).all()
    assert fit(docs.repartition(5)) == found
    assert set(fit(docs, 4)) == {"a", "b", "c", "d"}
    with pytest.raises(ValueError, match="no words"):
        fit(docs, 1000)


def test_a_fit_leaves_its_vectors_and_a_training_its_predictions(spark):
    folder = lambda: {p.name for p in Path(session.shared_folder(spark)).glob(f"{spark.sparkContext.applicationId}/*")}
    rows = [(str(k), f"{TEXTS[k % 7]} w{k % 5}", k, k, (k % 3 - 1) / 2, 0.5) for k in range(60)]
    cleaned = spark.createDataFrame(rows, "id string, title_clean string, score bigint, num_comments bigint, polarity double, subjectivity double")
    before, setting = folder(), spark.conf.get(session.SHUFFLES_END)
    found = training.train(cleaned, "id", vector_tasks=2)
    left = sorted(n.rsplit("-", 1)[0] for n in folder() - before)
    assert left == ["predictions", "word-vectors"] and spark.conf.get(session.SHUFFLES_END) == setting
    assert found.predictions.count() == found.confusion.agg(F.sum("n")).head()[0] > 0
    assert found.model.transform(found.predictions.drop(*[c for c in found.predictions.columns if c not in cleaned.columns])).count() > 0


def test_one_word_has_a_vector(spark):
    one = spark.createDataFrame([(["a", "a"],)], "words array<string>")
    assert [r["word"] for r in skipgram.SkipGram("words", "v", 3)._fit(one).vectors.collect()] == ["a"]


def test_the_pipeline_holds_no_words_on_the_driver():
    assert isinstance(training.build_pipeline().getStages()[1], skipgram.SkipGram)


def test_rows_to_train_on_are_scored_once(spark):
    rows = [("good", 1, 2, 0.5, 0.2), ("bad", 1, 2, None, 0.2), ("nan", 1, 2, float("nan"), 0.2), ("loss", 1, 2, -0.5, float("nan")), (None, 1, 2, 0.5, 0.2), ("plain", 1, None, 0.0, 0.0), ("day", 1, 2, 0.0, 0.0)]
    raw = spark.createDataFrame(rows, "title_clean string, score int, num_comments int, valence double, weight double")
    cleaned = raw.select("title_clean", "score", "num_comments", F.sqrt(F.col("valence") * F.abs("valence")).alias("polarity"), F.col("weight").alias("subjectivity"))
    found = training.labelled(cleaned)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("SQRT") == 1
    want = {r["title_clean"]: r["label"] for r in training.labelled(raw.select("title_clean", "score", "num_comments", F.col("valence").alias("polarity"), F.col("weight").alias("subjectivity"))).collect()}
    assert want == {"good": 2.0, "nan": 1.0, "day": 1.0}
    assert {r["title_clean"]: r["label"] for r in found.collect()} == want
