"""A three-class headline classifier with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import Classifier, DecisionTreeClassifier
from pyspark.ml.feature import IDF, HashingTF, Tokenizer, VectorAssembler, VectorSizeHint
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scoring import polarity_label
from tidemark.operators.evaluate import confusion, metrics
from tidemark.operators.rows import computed, split_rows
from tidemark.operators.skipgram import SkipGram
from tidemark.session import lent, shuffles_end, staged

# Model sizes.
VECTOR_SIZE = 3
TERM_SLOTS = 100
MIN_DOC_FREQ = 5
TREE_DEPTH = 9
# Word vectors: the least number of parts that are trained apart and averaged, and passes over the rows.
VECTOR_TASKS, VECTOR_ROUNDS = 16, 2


def build_pipeline(
    vec: int = VECTOR_SIZE,
    tf: int = TERM_SLOTS,
    min_df: int = MIN_DOC_FREQ,
    depth: int = TREE_DEPTH,
    classifier: Classifier | None = None,
    seed: int = 0,
    min_count: int = 0,
    vector_tasks: int = VECTOR_TASKS,
    word_vectors: Estimator | None = None,
) -> Pipeline:
    """Word vectors, hashed term weights and three numbers into a classifier.

    Any classifier that reads ``features`` and ``label`` can replace the decision tree, and any stage from
    ``words`` to ``headline_vector`` of ``vec`` numbers the skip-grams, such as
    :class:`tidemark.operators.vectors.CountVectors` or the library's ``Word2Vec``. The size hints let the pipeline check vectors on a stream.
    """
    if classifier is None:
        classifier = DecisionTreeClassifier(maxDepth=depth, seed=seed)
    if word_vectors is None:
        word_vectors = SkipGram("words", "headline_vector", vec, min_count, vector_tasks, VECTOR_ROUNDS, seed)
    numbers = ["score", "num_comments", "subjectivity"]
    return Pipeline(
        stages=[
            Tokenizer(inputCol="title_clean", outputCol="words"),
            word_vectors,
            HashingTF(numFeatures=tf, inputCol="words", outputCol="word_counts"),
            IDF(minDocFreq=min_df, inputCol="word_counts", outputCol="word_frequency"),
            VectorSizeHint(inputCol="headline_vector", size=vec),
            VectorSizeHint(inputCol="word_frequency", size=tf),
            VectorAssembler(
                inputCols=["headline_vector", *numbers, "word_frequency"], outputCol="features"
            ),
            classifier,
        ]
    )


def labelled(cleaned: DataFrame) -> DataFrame:
    """Rows the pipeline can read: complete, with the label of their polarity."""
    # Computed apart: the test for missing values would otherwise repeat what the numbers are computed from.
    rows = computed(cleaned, polarity_label(F.col("polarity")), "label")
    return rows.na.drop("any", subset=["title_clean", "score", "num_comments", "subjectivity", "label"])


@dataclass
class Trained:
    """A fitted model, its predictions on the rows held back, and their measures."""

    model: PipelineModel
    predictions: DataFrame
    confusion: DataFrame
    metrics: DataFrame


def train(
    cleaned: DataFrame,
    key: str,
    parts: int = 4,
    min_count: int = 0,
    **pipeline,
) -> Trained:
    """Fit on three quarters of the rows and measure on the rest.

    The word vectors are fitted and kept as tables (:class:`tidemark.operators.skipgram.SkipGram`); ``min_count`` says
    which words they have. Parts of the rows are trained apart and averaged: at least ``vector_tasks``, more when there
    are more tokens. The stage that ``word_vectors`` names can replace it. The fit reads the training rows several
    times, so they are staged, in even partitions whatever the sizes of the input files, until it ends. So are the
    predictions, which stay: each reading of them would otherwise apply the model again. So a stage that ``word_vectors``
    names must not read its rows again after its fit.
    """
    rows = labelled(cleaned).select(key, "title_clean", "score", "num_comments", "subjectivity", "label").repartition(key)
    with shuffles_end(cleaned.sparkSession), lent(rows, "training") as rows:
        training, validation = split_rows(rows, key, parts)
        stages = build_pipeline(min_count=min_count, **pipeline).getStages()
        words = Pipeline(stages=stages[:3]).fit(training)
        # The stages after the word vectors and the term counts read their rows several times, but no words.
        with lent(words.transform(training).drop("title_clean", "words"), "training-vectors") as vectors:
            rest = Pipeline(stages=stages[3:]).fit(vectors)
        model = PipelineModel([*words.stages, *rest.stages])
        predictions = staged(model.transform(validation), "predictions")
    counts = confusion(predictions)
    return Trained(model, predictions, counts, metrics(counts))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
