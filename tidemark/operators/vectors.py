"""Word vectors from counts: words in a window, positive pointwise mutual information, its leading eigenvectors.

All tables are DataFrames of any size; what comes to the driver are square matrices of the vectors' length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import new_folder, staged

WINDOW = 5
MAX_WORDS = 1_000_000  # that a pipeline stage holds


def _fits(df: DataFrame) -> bool:
    """Whether a table has at most ``MAX_WORDS`` rows; such a table of words is joined as a broadcast."""
    return df.limit(MAX_WORDS + 1).count() <= MAX_WORDS


def cooccurrences(df: DataFrame, tokens: str, window: int = WINDOW, min_count: int = 1) -> DataFrame:
    """``word, context, n``: how often two words stand at most ``window`` places apart, counted in both directions.

    Pairs are listed inside the row, equal ones are added up in each task before the shuffle, each as one direction. Words
    that occur fewer than ``min_count`` times are left out of the pairs, not of the places; null tokens never count. Up to
    ``MAX_WORDS`` known words are broadcast, so that pairs are shuffled as two numbers and without unknown words; more are
    joined after the counting.
    """
    words = F.col(tokens)
    later = [F.slice(words, d, F.greatest(F.size(words) - (d - 1), F.lit(0))).alias(f"w{d}") for d in range(2, window + 2)]
    # Shifted arrays side by side, in a generator without lambdas. An outer one, since Catalyst filters on the size of a
    # plain one's array, which it would compute twice.
    placed = df.select(F.inline_outer(F.arrays_zip(words.alias("w1"), *later)))

    def listed(rows: DataFrame) -> DataFrame:
        """``one, other`` of rows of a word and those after it."""
        others = F.array(*[F.struct(F.col(f"w{d}").alias("other")) for d in range(2, window + 2)])
        return rows.where(F.col("w1").isNotNull()).select(F.col("w1").alias("one"), F.inline(others)).where(F.col("other").isNotNull())

    def added(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(F.least("one", "other").alias("word"), F.greatest("one", "other").alias("context")).agg(F.count(F.lit(1)).alias("n"))

    if min_count > 1:
        times = df.select(F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("times"))
        known = staged(times.where(F.col("times") >= min_count).select("word", F.monotonically_increasing_id().alias("number")), "words")
        if _fits(known):
            ones = F.broadcast(known.select(F.col("word").alias("w1"), F.col("number").alias("one")))
            others = F.broadcast(known.select(F.col("word").alias("other"), F.col("number").alias("second")))
            # The first word is looked up once for all its pairs.
            first = placed.join(ones, "w1").drop("w1").withColumnRenamed("one", "w1")
            counted = added(listed(first).join(others, "other").select("one", F.col("second").alias("other")))
            names = [F.broadcast(known.select(F.col("number").alias(c), F.col("word").alias(f"_{c}"))) for c in ("word", "context")]
            counted = counted.join(names[0], "word").join(names[1], "context").select(F.col("_word").alias("word"), F.col("_context").alias("context"), "n")
        else:
            known = known.select("word")
            counted = added(listed(placed)).join(known, "word", "left_semi").join(known.withColumnRenamed("word", "context"), "context", "left_semi")
    else:
        counted = added(listed(placed))
    same = F.col("word") == F.col("context")
    one = F.struct("word", "context", F.when(same, 2 * F.col("n")).otherwise(F.col("n")).alias("n"))
    back = F.struct(F.col("context").alias("word"), F.col("word").alias("context"), F.col("n").alias("n"))
    return counted.select(F.inline(F.when(same, F.array(one)).otherwise(F.array(one, back))))


def ppmi(counts: DataFrame) -> DataFrame:
    """``word, context, value``: the positive pointwise mutual information of the pairs of :func:`cooccurrences`."""
    counts = staged(counts, "cooccurrences")
    sums = staged(counts.groupBy("word").agg(F.sum("n").alias("of_word")), "word-sums")
    total = counts.select(F.sum("n").cast("double")).scalar()
    if _fits(sums):
        sums = F.broadcast(sums)
    joined = counts.join(sums, "word").join(sums.select(F.col("word").alias("context"), F.col("of_word").alias("of_context")), "context")
    together, chance = F.col("n").cast("double") * total, F.col("of_word").cast("double") * F.col("of_context").cast("double")
    return joined.where(together > chance).select("word", "context", F.ln(together / chance).alias("value"))


def _combined(names: Sequence[str], weights: np.ndarray) -> Column:
    """The sum of columns times weights."""
    return sum((F.col(n) * float(w) for n, w in zip(names, weights, strict=True)), F.lit(0.0))


def _products(rows: DataFrame, left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """The matrix of sums of products of two columns each."""
    sums = rows.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in left for b in right]).head()
    return np.array([0.0 if x is None else x for x in sums]).reshape(len(left), len(right))


def leading_vectors(matrix: DataFrame, size: int, extra: int = 5, rounds: int = 12, tolerance: float = 1e-6) -> DataFrame:
    """``word, vector``: the ``size`` leading eigenvectors of a symmetric ``matrix`` of ``word, context, value``.

    Column j of the vectors is the eigenvector of the eigenvalue with the j-th largest absolute value, times the root of
    that value, its sign such that the sum of its cubes is not negative. Subspace iteration: a round is one join and one
    sum, the product of the matrix with the columns so far, which are then made orthonormal by their products with each
    other. ``extra`` further columns are carried along; it ends after ``rounds`` or when what the columns lack of
    being eigenvectors is at most ``tolerance`` of the largest eigenvalue. A round's result is staged, so no lineage grows.
    """
    x, y = [f"x{j}" for j in range(size + extra)], [f"y{j}" for j in range(size + extra)]
    # Entries of a word lie in one file, so that a task adds them up before the shuffle.
    entries = staged(matrix.repartition("word"), "entries")
    words = staged(entries.select("word").distinct(), "entry-words")
    small = _fits(words)
    # A zero on the diagonal gives each word its own columns back beside the product.
    entries = entries.unionByName(words.select("word", F.col("word").alias("context"), F.lit(0.0).alias("value")))
    now = words.select("word", *[(F.xxhash64("word", F.lit(j)) / 2.0**63).alias(c) for j, c in enumerate(x)])
    own = F.col("word") == F.col("context")
    orthonormal = False
    for k in range(rounds + 1):
        columns = now.withColumnRenamed("word", "context")
        joined = entries.join(F.broadcast(columns) if small else columns, "context")
        sums = [F.sum(F.col("value") * F.col(a)).alias(b) for a, b in zip(x, y, strict=True)]
        after = staged(joined.groupBy("word").agg(*sums, *[F.max(F.when(own, F.col(a))).alias(a) for a in x]), "subspace")
        squares = _products(after, y, y)
        if orthonormal:
            values, turn = np.linalg.eigh(np.nan_to_num((t := _products(after, x, y)) + t.T) / 2)
            order = np.argsort(-np.abs(values), kind="stable")[:size]
            values, turn = values[order], turn[:, order]
            lacking = np.einsum("ij,ik,kj->j", turn, squares, turn) - values**2
            if k == rounds or np.sqrt(max(lacking.max(initial=0.0), 0.0)) <= tolerance * np.abs(values).max(initial=0.0):
                return _signed(after.select("word", *[(_combined(x, turn[:, j]) * float(np.sqrt(abs(values[j])))).alias(f"v{j}") for j in range(len(order))]))
        lengths, axes = np.linalg.eigh(squares)
        kept = lengths > 1e-13 * max(lengths.max(initial=0.0), 1e-300)
        axes = np.where(kept, axes / np.sqrt(np.where(kept, lengths, 1.0)), 0.0)
        now = after.select("word", *[_combined(y, axes[:, j]).alias(c) for j, c in enumerate(x)])
        orthonormal = True
    raise AssertionError("the last round returns")


def _signed(rows: DataFrame) -> DataFrame:
    columns = [c for c in rows.columns if c != "word"]
    rows = staged(rows, "vectors")
    cubes = rows.agg(*[F.sum(F.pow(c, F.lit(3.0))).alias(c) for c in columns]).head()
    return rows.select("word", F.array(*[F.col(c) * (-1.0 if (s or 0.0) < 0 else 1.0) for c, s in zip(columns, cubes, strict=True)]).alias("vector"))


def word_vectors(df: DataFrame, tokens: str, size: int, window: int = WINDOW, min_count: int = 1, **iteration) -> DataFrame:
    """``word, vector`` of all words that stand beside another: leading vectors of their mutual information."""
    return leading_vectors(ppmi(cooccurrences(df, tokens, window, min_count)), size, **iteration)


def mean_vectors(df: DataFrame, id_col: str, tokens: str, vectors: DataFrame, size: int, out: str = "vector") -> DataFrame:
    """``id, out``: the sum of a row's word vectors over the number of its words; zeros for a row without a known word.

    A join, for a vocabulary of any size. Equal words of a row are counted inside it, and Spark chooses the join by
    the size of ``vectors``.
    """
    words = F.filter(F.coalesce(F.col(tokens), F.array()), lambda w: w.isNotNull())
    count = lambda w: F.size(F.filter(words, lambda v: v == w))
    counted = F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("word"), (count(w) / F.size(words)).alias("share")))
    listed = df.select(id_col, F.explode_outer(counted).alias("w")).select(id_col, "w.word", "w.share")
    joined = listed.join(vectors, "word", "left")
    parts = [F.coalesce(F.sum(F.col("share") * F.get("vector", F.lit(j))), F.lit(0.0)) for j in range(size)]
    return joined.groupBy(id_col).agg(F.array(*parts).alias(out))


class CountVectors(Estimator):
    """A stage that stands in for the library's word vectors; its model is the library's own, with these vectors.

    The fit runs in as many tasks as the data needs. The model holds the vocabulary in memory, so more than
    ``max_words`` words raise; :func:`mean_vectors` takes any number.
    """

    def __init__(self, input_col: str, output_col: str, size: int, window: int = WINDOW, min_count: int = 1, max_words: int = MAX_WORDS, **iteration):
        super().__init__()
        self.input_col, self.output_col, self.size = input_col, output_col, size
        self.window, self.min_count, self.max_words, self.iteration = window, min_count, max_words, iteration

    def _fit(self, dataset: DataFrame) -> Word2VecModel:
        spark = dataset.sparkSession
        found = staged(word_vectors(dataset, self.input_col, self.size, self.window, self.min_count, **self.iteration), "word-vectors")
        if found.count() > self.max_words:
            raise ValueError(f"more than {self.max_words} words; raise min_count or use mean_vectors")
        # A model of the library is saved and its table of vectors replaced, which is how it can be given any.
        path = new_folder(spark, "word-vectors-model")
        one = spark.createDataFrame([(["a"],)], [self.input_col])
        plain = Word2Vec(vectorSize=self.size, minCount=0, inputCol=self.input_col, outputCol=self.output_col)
        plain.fit(one).write().save(path)
        layout = spark.read.parquet(f"{path}/data").schema
        padded = F.concat("vector", F.array_repeat(F.lit(0.0), self.size))
        rows = found.select("word", F.slice(padded, 1, self.size).cast("array<float>").alias("vector"))
        rows.select(*layout.names).write.mode("overwrite").parquet(f"{path}/data")
        return Word2VecModel.load(path)
