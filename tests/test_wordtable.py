"""Word vectors as a table against the library's own model."""

import time
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Tokenizer, Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import wordtable
from tidemark.operators.wordtable import TabledWord2Vec, WordTable
from tidemark.streaming import headlines as streaming

TEXTS = ["good win today", "bad loss", "", "bad bad day bad", "plain day unseen", "win"] * 5


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t.split(), t) for k, t in enumerate(TEXTS)] + [(90, ["good", None, "win"], None), (90, ["good", None, "win"], None)]
    return spark.createDataFrame(rows, "id int, words array<string>, text string").repartition(3)


@pytest.fixture(scope="module")
def fitted(docs):
    fit = Word2Vec(vectorSize=3, minCount=0, numPartitions=1, seed=3, inputCol="words", outputCol="v")
    return TabledWord2Vec(fit)._fit(docs.where("id < 4"))


def folders(spark):
    """What lies in the shared folder."""
    path = Path(session.shared_folder(spark)) / spark.sparkContext.applicationId
    return {p.name for p in path.iterdir()} if path.exists() else set()


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = disk.getAllBlocks()
    names = {blocks.apply(k).toString() for k in range(blocks.size())}
    return {n for n in names if n.startswith("shuffle_")}


def ends(test, seconds=20):
    """Spark removes shuffle files a little later."""
    for _ in range(10 * seconds):
        if test():
            return True
        time.sleep(0.1)
    return False


def numbers(df):
    return sorted(df.select("id", "text", vector_to_array("v").alias("v")).collect(), key=str)


def test_means_are_those_of_the_library(spark, docs, fitted, tmp_path, monkeypatch):
    monkeypatch.setattr(wordtable, "LEAST_TOKENS", 10)  # several blocks
    fitted.save(str(tmp_path / "table"))
    one = spark.createDataFrame([(["a"],)], ["words"])
    Word2Vec(vectorSize=3, minCount=0, inputCol="words", outputCol="v").fit(one).write().save(str(tmp_path / "library"))
    fitted.vectors.write.mode("overwrite").parquet(str(tmp_path / "library/data"))
    want = Word2VecModel.load(str(tmp_path / "library")).transform(docs)
    assert numbers(fitted.transform(docs)) == numbers(want)
    again = WordTable.load(str(tmp_path / "table"))
    assert numbers(again.transform(docs)) == numbers(want) and again.uid == fitted.uid
    again.write().overwrite().save(str(tmp_path / "table"))  # over the folder it was read from
    assert numbers(WordTable.load(str(tmp_path / "table")).transform(docs)) == numbers(want)


def test_other_columns_and_empty_tables_stay(docs, fitted):
    vectors = fitted.transform(docs.withColumn("w", F.col("words")).drop("words").withColumnRenamed("w", "words")).select("id", "v", F.col("v").alias("of"))
    assert vectors.count() == len(TEXTS) + 2
    with_vector = fitted.transform(vectors.select("id", "of", F.array(F.lit("win")).alias("words")))
    assert with_vector.where(F.col("of").isNull() | F.col("v").isNull()).count() == 0
    assert fitted.transform(docs.where("false")).collect() == []


def test_a_large_table_of_words_is_not_broadcast(spark, docs, fitted):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = fitted.transform(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "FlatMapCoGroupsInArrow" in plan and "Broadcast" not in plan


def test_a_small_table_of_words_is_not_collected_either(docs, fitted):
    plan = fitted.transform(docs)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_predictions_prepare_the_rows_once(spark, fitted):
    raw = spark.createDataFrame([("Good, win!", 1, None), ("bad", None, 2), (None, 1, 1), ("bad", None, 2), ("", 3, 4)], "title string, score bigint, num_comments bigint")
    prepared = streaming.prepare(raw, ["say"], {"bad": 0.5})
    model = PipelineModel([Tokenizer(inputCol="title_clean", outputCol="words"), WordTable(fitted.vectors, "words", "prediction", 3)])
    found = streaming.predict(prepared, model)
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.columns == ["title", "prediction"]
    want = model.transform(prepared).select("title", "prediction").collect()
    assert sorted(map(str, found.collect())) == sorted(map(str, want)) and len(want) == 4


@pytest.mark.parametrize("least", [1, 2_000, 10**9])
def test_a_batch_is_scored_in_slices_that_leave_nothing(spark, fitted, tmp_path, monkeypatch, least):
    monkeypatch.setattr(streaming, "LEAST_SLICE", least)
    rows = [(f"good {k % 30} bad", k % 3 or None, k % 30) for k in range(60)] + [(None, 1, 1), ("", 3, None), ("bad", 2**60, 5)]
    raw = spark.createDataFrame(rows, "title string, score bigint, num_comments bigint")
    model = PipelineModel([Tokenizer(inputCol="title_clean", outputCol="words"), WordTable(fitted.vectors, "words", "prediction", 3)])
    want = model.transform(streaming.prepare(raw, ["say"], {"bad": 0.5})).select("title", "prediction").collect()
    before, setting = folders(spark), spark.conf.get(session.SHUFFLES_END)
    found = streaming.score_batch(raw, model, str(tmp_path / "out"), ["say"], {"bad": 0.5})
    assert found.columns == ["title", "prediction"] and sorted(map(str, found.collect())) == sorted(map(str, want))
    assert folders(spark) == before and spark.conf.get(session.SHUFFLES_END) == setting
    slices = len(list((tmp_path / "out").glob("slice=*")))
    assert slices == streaming.SLICES if least == 1 else slices == 1 if least == 10**9 else 1 < slices <= streaming.SLICES
    none = streaming.score_batch(raw.where("false"), model, str(tmp_path / "none"), [], {})
    assert none.columns == found.columns and none.count() == 0


def test_a_stream_leaves_the_predictions_only(spark, fitted, tmp_path):
    rows = spark.createDataFrame([("good win", 1, 2), ("bad", 2, None)], "title string, score bigint, num_comments bigint")
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    model = PipelineModel([Tokenizer(inputCol="title_clean", outputCol="words"), WordTable(fitted.vectors, "words", "prediction", 3)])
    before, files = folders(spark), shuffle_files(spark)
    streaming.score_stream(stream, model, str(tmp_path / "c"), [], {}, sink="parquet", path=str(tmp_path / "out"), available_now=True)
    assert folders(spark) == before
    assert ends(lambda: shuffle_files(spark) - files == set())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("sink", ["memory", "console", "json"])
def test_streams_are_scored_by_batches(spark, fitted, tmp_path, monkeypatch, sink):
    rows = spark.createDataFrame([("good win", 1), ("bad", 2)], "title string, k int").withColumn("words", F.split("title", " "))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    monkeypatch.setattr(streaming, "predict", lambda df, model: model.transform(df).select("title", vector_to_array("v").alias("prediction")))
    where = {"name": "scored"} if sink == "memory" else {"path": str(tmp_path / "out")} if sink == "json" else {}
    query = streaming.start_predictions(stream, PipelineModel([fitted]), str(tmp_path / "c"), sink, available_now=True, **where)
    query.awaitTermination()
    assert query.exception() is None
    if sink != "console":
        got = spark.table("scored") if sink == "memory" else spark.read.json(str(tmp_path / "out"))
        want = {r["title"]: list(r["v"]) for r in fitted.transform(rows).collect()}
        assert {r["title"]: r["prediction"] for r in got.collect()} == want


@pytest.mark.parametrize("blocks", [1, 64, 65, 130])
def test_words_are_told_apart_by_one_shuffle_of_a_row_per_word(spark, blocks):
    rows = spark.createDataFrame([(b, ["a", None, f"w{b % 7}", "a"]) for b in range(blocks)] + [(0, None), (0, [])], "_block int, words array<string>")
    marked = wordtable.marked_words(rows.withColumn("words", F.transform("words", F.upper)), "words", blocks)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(word" in plan and plan.count("transform(words") == 1
    found = [(r["word"], r["_of"], r["n"]) for r in wordtable.words_of_blocks(marked, blocks).collect()]
    n = {f"W{k}": len(range(k, blocks, 7)) for k in range(7)}
    assert sorted(found) == sorted([("A", b, 2 * blocks) for b in range(blocks)] + [(f"W{b % 7}", b, n[f"W{b % 7}"]) for b in range(blocks)])
