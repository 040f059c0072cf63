"""Word vectors as a table that rows are joined with, so that no process holds all words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.session import new_folder, staged

BLOCK_TOKENS = 2_000_000  # tokens of the rows that a task holds at a time
LEAST_TOKENS = 50_000  # fewer are not dealt to another task


def in_blocks(df: DataFrame, blocks: int) -> DataFrame:
    """``df`` with the ``_block`` of each row, which its values decide alone: rows that are read again get the same one."""
    values = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return df.withColumn("_block", F.pmod(F.xxhash64(*values), F.lit(blocks)).cast("int"))


def block_marks(of: str, blocks: int) -> list[Column]:
    """Aggregates ``_in0, ...``: a bit for each block in the column ``of``, 64 to a number."""
    bit = F.expr(f"shiftleft(1L, {of})")  # the shift is taken modulo 64
    return [F.bit_or(F.when(F.expr(f"{of} div 64") == k, bit).otherwise(F.lit(0))).alias(f"_in{k}") for k in range(-(-blocks // 64))]


def marked_words(rows: DataFrame, tokens: str, blocks: int) -> DataFrame:
    """``word, n, _in0, ...``: each word once, how often it occurs, and the marks of the blocks that have it."""
    # Of a plain column Spark would first test that it has tokens, and so split the texts twice.
    each = F.explode(F.coalesce(tokens, F.array().cast("array<string>")))
    listed = rows.select("_block", each.alias("word")).where(F.col("word").isNotNull())
    return listed.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *block_marks("_block", blocks))


def words_of_blocks(marked: DataFrame, blocks: int) -> DataFrame:
    """Each row with :func:`block_marks` once for each of its blocks, ``_of``, without the marks."""
    every = marked.withColumn("_of", F.explode(F.lit(list(range(blocks)))))
    marks = [f"_in{k}" for k in range(-(-blocks // 64))]
    mark = F.col(marks[-1])
    for k in range(len(marks) - 2, -1, -1):
        mark = F.when(F.col("_of") < 64 * (k + 1), F.col(marks[k])).otherwise(mark)
    return every.where(mark.bitwiseAND(F.expr("shiftleft(1L, _of)")) != 0).drop(*marks)


def count_tokens(df: DataFrame, tokens: str) -> int:
    return df.agg(F.sum(F.greatest(F.coalesce(F.size(tokens), F.lit(0)), F.lit(0)).cast("bigint"))).head()[0] or 0


def _means(tokens: str, out: str, size: int) -> Callable:
    """Adds up the vectors of the words of each row, in their order, for the rows and the words of a block."""

    def run(rows: pa.Table, words: pa.Table) -> pa.Table:
        lists = rows.column(tokens).combine_chunks()
        at = pc.index_in(pc.list_flatten(lists), value_set=words.column("word").combine_chunks()).fill_null(-1).to_numpy()
        row, known = pc.list_parent_indices(lists).to_numpy(), at >= 0
        numbers = pc.list_flatten(words.column("vector").combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, size).astype(float)
        share = 1.0 / np.maximum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), 1)
        sums = [np.bincount(row[known], numbers[at[known], j], rows.num_rows) * share for j in range(size)]
        vectors = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(sums, 1).ravel()), size).cast(pa.list_(pa.float64()))
        return rows.drop_columns(["_block"]).append_column(out, vectors)

    return run


class WordTable(Transformer, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """The mean of the vectors of a row's words; words without a vector count as zeros, as in the library's ``Word2VecModel``.

    ``vectors`` is a table ``word, vector`` of any size, one row per word. The rows are dealt to blocks; the words of all rows,
    each with the blocks that have it, are joined with the table once and meet the rows of each block in one task. Nothing is broadcast or collected, whatever the
    table's size. The rows are read three times, so they are better staged. Rows of a stream are joined by batches
    (``foreachBatch``). A row without words has zeros. The numbers are added in the order of
    the words, so a row has the same mean whatever its block.
    """

    size = Param(Params._dummy(), "size", "numbers of a vector", TypeConverters.toInt)

    def __init__(self, vectors: DataFrame, input_col: str = "words", output_col: str = "vector", size: int = 0):
        super().__init__()
        self.vectors = vectors
        self._set(inputCol=input_col, outputCol=output_col, size=size)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if dataset.isStreaming:
            raise ValueError("a table of words is joined in batches; apply the model in foreachBatch")
        tokens, out, size = self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.size)
        n = count_tokens(dataset, tokens)
        tasks = dataset.sparkSession.sparkContext.defaultParallelism
        blocks = max(-(-n // BLOCK_TOKENS), min(4 * tasks, n // LEAST_TOKENS), 1)
        rows = in_blocks(dataset, blocks)
        # Hashed are the words of the rows, the table only passes by: it is neither collected to be broadcast nor sorted.
        marked = marked_words(rows, tokens, blocks).drop("n").hint("shuffle_hash")
        words = words_of_blocks(self.vectors.select("word", "vector").join(marked, "word"), blocks)
        schema = T.StructType([*dataset.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
        found = rows.groupBy("_block").cogroup(words.groupBy("_of")).applyInArrow(_means(tokens, out, size), schema)
        return found.withColumn(out, array_to_vector(F.col(f"`{out}`")))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: WordTable):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.vectors.select("word", "vector").write.parquet(f"{path}/data")


class _Reader(MLReader):
    def load(self, path: str) -> WordTable:
        """The table is staged, so that the model can be saved over its own folder."""
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = WordTable(staged(self.sparkSession.read.parquet(f"{path}/data"), "word-table"))
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        return found


class TabledWord2Vec(Estimator):
    """The library's word vectors, with a :class:`WordTable` as its model."""

    def __init__(self, fit: Word2Vec):
        super().__init__()
        self.word2vec = fit

    def _fit(self, dataset: DataFrame) -> WordTable:
        spark, fit = dataset.sparkSession, self.word2vec
        path = new_folder(spark, "word-vectors")
        fit.fit(dataset).write().save(path)
        return WordTable(spark.read.parquet(f"{path}/data"), fit.getInputCol(), fit.getOutputCol(), fit.getVectorSize())
