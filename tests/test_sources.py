"""Readers, writers, the paged source and streams."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import shared_folder
from tidemark.sources import files, paged, pages
from tidemark.streaming import headlines as streaming

START, COUNT = 1199174400, 100


def test_json_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"title":"a","score":1,"num_comments":2,"extra":5},{"title":"b","score":3}]')
    (tmp_path / "empty.json").write_text("[]")
    for multi_line in (False, True):
        got = files.read_headlines(spark, str(tmp_path), schemas.STREAM_HEADLINE, multi_line)
        assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 2), ("b", 3, None)]
    (tmp_path / "broken-over-lines.json").write_text(json.dumps([{"title": "c", "score": 4}], indent=2))
    got = files.read_headlines(spark, str(tmp_path), schemas.STREAM_HEADLINE, multi_line=True)
    assert got.count() == 3


def test_raw_layout():
    assert len(schemas.RAW_HEADLINE) == 51
    assert set(schemas.REQUIRED_RAW_FIELDS) <= set(schemas.RAW_HEADLINE.names)


def test_cleaned_dates_may_carry_a_time(spark, tmp_path):
    rows = [{"created_utc_iso": "2019-11-01T07:00:34", "polarity_subjectivity": [0.5]}, {"created_utc_iso": "2019-11-02"}]
    (tmp_path / "rows.json").write_text("\n".join(map(json.dumps, rows)))
    got = files.read_clean_headlines(spark, str(tmp_path), "json", paired=True).collect()
    assert [(str(r["created_utc_iso"]), r["polarity"], r["subjectivity"]) for r in got] == [
        ("2019-11-01", 0.5, None),
        ("2019-11-02", None, None),
    ]


def test_prices_by_symbol_file(spark, tmp_path):
    (tmp_path / "NKE.csv").write_text("Date,High,Open,Volume\n2004-12-31,9,1,5\n2005-01-03,9,2,6\n2006-01-03,9,3,null\n")
    (tmp_path / "XOM.csv").write_text("Date,High,Open,Volume\n2005-01-03,9,4,8.0\n")
    got = files.read_prices(spark, str(tmp_path), symbol_from_path=True)
    assert sorted((r["Company"], str(r["Date"]), r["Open"], r["Volume"]) for r in got.collect()) == [
        ("NKE", "2004-12-31", 1.0, 5.0), ("NKE", "2005-01-03", 2.0, 6.0), ("NKE", "2006-01-03", 3.0, None), ("XOM", "2005-01-03", 4.0, 8.0),
    ]
    assert [f.name for f in got.schema] == schemas.PRICE_BAR.names
    (tmp_path / "odd.csv").write_text("Date,Open,High,Volume\n2005-01-03,4,9,8.0\n")
    with pytest.raises(Exception, match="header"):
        files.read_prices(spark, [str(tmp_path / "NKE.csv"), str(tmp_path / "odd.csv")], symbol_from_path=True).collect()
    until = files.read_prices(spark, [str(tmp_path / "NKE.csv")], None, dt.date(2005, 1, 3), symbol_from_path=True)
    assert until.count() == 2
    assert files.read_prices(spark, [str(tmp_path / "NKE.csv")], dt.date(2005, 1, 1), symbol_from_path=True).count() == 2


def test_symbols_of_folders_stay_text(spark, tmp_path):
    for symbol in ("000001", "1e3", "1"):
        (tmp_path / f"Company={symbol}").mkdir()
        (tmp_path / f"Company={symbol}" / "a.csv").write_text("Date,Open,Volume\n2005-01-03,4,8.0\n")
    assert sorted(r["Company"] for r in files.read_prices(spark, str(tmp_path)).collect()) == ["000001", "1", "1e3"]


def test_daily_series_takes_its_first_column_as_the_date(spark, tmp_path):
    (tmp_path / "s.csv").write_text("when,a,b\n2020-01-02,1,2\n2020-01-03,,4\n")
    got = files.read_daily(spark, str(tmp_path / "s.csv"), ["b", "a"]).collect()
    assert [(str(r["Date"]), r["b"], r["a"]) for r in got] == [("2020-01-02", 2.0, 1.0), ("2020-01-03", 4.0, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string").repartition(2)
    plain, single, parted = (str(tmp_path / n) for n in ("plain", "single", "parted"))
    for _ in range(2):
        files.write_table(df, plain, "csv", compression="gzip")
    parts = list((tmp_path / "plain").glob("*.csv.gz"))
    assert sorted("".join(gzip.open(p, "rt").read() for p in parts).split()) == ["1,a", "2,b"]
    files.write_table(df, single, "csv", header=True, single_file=True)
    [only] = (tmp_path / "single").glob("*.csv")
    assert sorted(only.read_text().split()) == ["1,a", "2,b", "n,s"]
    files.write_table(df, parted, partition_by=["s"])
    assert sorted(p.name for p in (tmp_path / "parted").glob("s=*")) == ["s=a", "s=b"]
    with pytest.raises(Exception, match="exists"):
        files.write_table(df, parted, mode="error")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# Pages


def test_drained_pages(spark, tmp_path):
    df = spark.createDataFrame([(START + i // 3, i) for i in range(20)], "created_utc bigint, id bigint")
    cursor, count = pages.drain_pages(lambda: df, str(tmp_path / "feed"), ["created_utc", "id"], (0, 0), 6)
    assert (cursor, count) == ([START + 6, 19], 4)
    feed = spark.read.schema("created_utc bigint, id bigint").json(str(tmp_path / "feed" / "*"))
    assert sorted(r["id"] for r in feed.collect()) == list(range(20))


def test_written_pages_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([(START + i // 3, str(i), f"t{i}", i) for i in range(20)], "created_utc bigint, id string, title string, score bigint")
    pages.write_pages(df, str(tmp_path / "pages"), ["created_utc", "id"], 6)
    got = files.read_headlines(spark, str(tmp_path / "pages")).select(*df.columns)
    assert got.exceptAll(df).isEmpty() and got.count() == 20


def feed():
    """A feed of 100 rows, three per second."""

    def fetch(after, until, size):
        when, last = after
        rows = [(START + i // 3, i, f"title {i}") for i in range(100)]
        newer = [r for r in rows if (r[0] > when or r[0] == when and (last is None or r[1] > last)) and r[0] < until]
        return newer[:size]

    return paged.paged_source("headline_feed", "created_utc bigint, id bigint, title string", fetch)


@pytest.mark.parametrize("size, width", [(4, 10), (1, 7), (500, 86400)])
def test_paged_batch(spark, size, width):
    spark.dataSource.register(feed())
    got = spark.read.format("headline_feed").options(end=START + 30, slice=width, size=size).load()
    assert sorted(r["id"] for r in got.collect()) == list(range(90))
    assert got.rdd.getNumPartitions() == -(-30 // width)


def shown_feed(path):
    """A feed whose rows stand in a file, which a test may change."""

    def rows():
        return sorted(map(tuple, json.loads(path.read_text())))

    def fetch(after, until, size):
        when, last = after
        newer = [r for r in rows() if (r[0] > when or r[0] == when and (last is None or r[1] > last)) and r[0] < until]
        return newer[:size]

    def newest():
        return max(rows(), default=None)

    return paged.paged_source("shown_feed", "created_utc bigint, id bigint", fetch, newest)


def show(path, rows):
    path.write_text(json.dumps(sorted(rows)))


def followed(spark, tmp_path, overlap, **options):
    rows = paged.follow(spark, "shown_feed", overlap=overlap, slice=5, size=4, **options)
    return streaming.start(rows, str(tmp_path / "c"), "parquet", str(tmp_path / "out"))


def seen(spark, tmp_path):
    return sorted(tuple(r) for r in spark.read.schema("created_utc bigint, id bigint").parquet(str(tmp_path / "out")).collect())


def test_stream_goes_on_after_its_last_key(spark, tmp_path):
    """Rows that share the last second come later, and nothing new starts no batch."""
    feed_file = tmp_path / "feed.json"
    spark.dataSource.register(shown_feed(feed_file))
    first = [(START + k // 3, k) for k in range(20)]
    show(feed_file, first)
    query = followed(spark, tmp_path, 0)
    query.processAllAvailable()
    batch = query.lastProgress["batchId"]
    assert seen(spark, tmp_path) == first
    query.processAllAvailable()
    offsets = (tmp_path / "c" / "offsets" / str(batch)).read_text().splitlines()
    assert json.loads(offsets[-1]) == {"time": START + 6, "id": 19}
    assert not list((tmp_path / "c" / "offsets").glob(str(batch + 2)))
    more = [(START + 6, 20), (START + 6, 21), (START + 30, 22)]
    show(feed_file, first + more)
    query.processAllAvailable()
    query.stop()
    assert seen(spark, tmp_path) == first + more


@pytest.mark.parametrize("restart", [False, True])
def test_rows_shown_late_come_once(spark, tmp_path, restart):
    feed_file = tmp_path / "feed.json"
    spark.dataSource.register(shown_feed(feed_file))
    every = [(START + 10 * k, 2 * k + e) for k in range(30) for e in (0, 1)]
    late = {every[k] for k in (40, 45, 51)}  # up to 90 seconds behind the newest row of the first run
    too_late = every[3]
    half = [r for r in every[:52] if r not in late and r != too_late]
    show(feed_file, half)
    query = followed(spark, tmp_path, 100)
    query.processAllAvailable()
    assert seen(spark, tmp_path) == sorted(half)
    if restart:
        query.stop()
    show(feed_file, every)
    if restart:
        query = followed(spark, tmp_path, 100)
    query.processAllAvailable()
    query.stop()
    assert seen(spark, tmp_path) == sorted(r for r in every if r != too_late)


def test_a_batch_is_read_again_from_its_two_offsets():
    rows = [(100 + k // 4, k) for k in range(200)]

    def fetch(after, until, size):
        newer = [r for r in rows if (r[0] > after[0] or r[0] == after[0] and (after[1] is None or r[1] > after[1])) and r[0] < until]
        return newer[:size]

    def read(start, end, **more):
        parts = paged.slices_between(start, end, 7, **more)
        return [r for p in parts for r in paged.read_slice(fetch, p, 3)]

    offsets = [{"time": 90, "id": None}] + [{"time": rows[k][0], "id": rows[k][1]} for k in (0, 1, 30, 31, 120, 199)]
    for start, end in zip(offsets, offsets[1:]):
        low = -1 if start["id"] is None else start["id"]
        assert read(start, end) == read(start, end) == rows[low + 1 : end["id"] + 1]
        again = read(start, end, overlap=5, least=90)
        assert again == [r for r in rows if start["time"] - 5 <= r[0] and r[1] <= end["id"]]
    assert read(offsets[3], offsets[3]) == read(offsets[0], offsets[0]) == read(offsets[4], offsets[1]) == []


def test_a_feed_without_its_newest_key_is_no_stream(spark, tmp_path):
    spark.dataSource.register(feed())
    with pytest.raises(Exception, match="key of its last row"):
        query = streaming.start(spark.readStream.format("headline_feed").load(), str(tmp_path / "c"), "memory", name="none")
        query.processAllAvailable()


def test_slices_are_a_feed(spark, tmp_path):
    path, key = str(tmp_path / "slices"), ("t", "id")
    df = spark.range(3000).select((START + F.col("id") * 7 % 500).alias("t"), "id", F.concat(F.lit("r"), "id").alias("name"))
    pages.write_slices(df.where("id % 2 = 0").union(df.limit(1).selectExpr("null", "id", "name")), path, key, 60)
    pages.write_slices(df.where("id % 2 = 1"), path, key, 60)
    fetch, newest = pages.sliced_feed(path, key, 60, ["name"])
    rows = sorted((START + k * 7 % 500, k, f"r{k}") for k in range(3000))
    assert newest() == rows[-1][:2]
    part = paged.TimeSlice(START, START + 500)
    for size in (7, 500, 5000):
        assert list(paged.read_slice(fetch, part, size)) == rows
    assert fetch((START + 499, rows[-1][1]), START + 500, 5) == [] == fetch((START + 10**6, None), START + 10**6 + 1, 5)
    assert pages.sliced_feed(str(tmp_path / "none"), key, 60)[1]() is None


# Streams


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(rows))


def test_stream_equals_batch_and_survives_missing_titles(spark, tmp_path):
    titles = ["Good day", None, "The BAD of all, of_all", ""]
    drop(tmp_path / "in", "1.json", [{"title": t, "score": 1, "num_comments": i} for i, t in enumerate(titles)])
    args = (["the", "of"], {"good": 0.5, "bad": 0.9})
    rows = files.stream_headlines(spark, str(tmp_path / "in"))
    for name in ("1", "2"):
        query = streaming.start(
            streaming.prepare(rows, *args), str(tmp_path / "c"), "parquet", str(tmp_path / "out"), available_now=True
        )
        query.awaitTermination()
        drop(tmp_path / "in", "2.json", [{"title": "late but good"}])
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = streaming.prepare(files.read_headlines(spark, str(tmp_path / "in"), schemas.STREAM_HEADLINE), *args)
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert sorted(r["title_clean"] for r in got.collect()) == ["", "bad all ofall", "good day", "late but good"]


def test_console_sink(spark, tmp_path):
    drop(tmp_path / "in", "1.json", [{"title": "a"}])
    rows = files.stream_headlines(spark, str(tmp_path / "in")).select("title")
    query = streaming.start(rows, str(tmp_path / "c"), available_now=True)
    query.awaitTermination()
    assert query.exception() is None


def test_memory_sink(spark, tmp_path):
    drop(tmp_path / "in", "1.json", [{"title": "a"}, {"title": "b"}])
    rows = files.stream_headlines(spark, str(tmp_path / "in")).select("title")
    streaming.start(rows, str(tmp_path / "c"), "memory", name="seen", available_now=True).awaitTermination()
    assert {r["title"] for r in spark.table("seen").collect()} == {"a", "b"}


def test_model_on_a_stream(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    from tidemark.plans import training

    cleaned = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, "good win").when(F.col("id") % 3 == 1, "bad loss").otherwise("plain day").alias("title_clean"),
        F.col("id").alias("score"),
        (F.col("id") % 7).alias("num_comments"),
        F.lit(0.5).alias("subjectivity"),
        F.when(F.col("id") % 3 == 0, 0.6).when(F.col("id") % 3 == 1, -0.6).otherwise(0.0).alias("polarity"),
    )
    trained = training.train(cleaned, "id")
    assert trained.metrics.head()["accuracy"] > 0.95
    assert trained.model.stages[-1].numFeatures == 106 and trained.model.stages[-1].numClasses == 3
    training.save_model(trained.model, str(tmp_path / "model"))
    training.save_model(trained.model, str(tmp_path / "model"))
    drop(tmp_path / "in", "1.json", [{"title": "Good win!", "score": 3, "num_comments": 3}, {"title": "Bad loss"}])
    query = streaming.score_stream(
        files.stream_headlines(spark, str(tmp_path / "in")),
        training.load_model(str(tmp_path / "model")),
        str(tmp_path / "c"),
        [],
        {"good": 0.5, "bad": 0.5},
        sink="parquet",
        path=str(tmp_path / "out"),
        available_now=True,
    )
    assert not query.isActive
    got = {r["title"]: r["prediction"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"Good win!": 2.0, "Bad loss": 0.0}
    other = training.train(cleaned, "id", classifier=LogisticRegression(maxIter=20))
    assert other.metrics.head()["accuracy"] > 0.9


def test_predictions_are_made_once(spark):
    from tidemark.operators.rows import split_rows
    from tidemark.plans import training

    word = F.when(F.col("id") % 2 == 0, "good").otherwise("bad")
    cleaned = spark.range(200).select(
        F.col("id").cast("string").alias("id"), word.alias("title_clean"), F.lit(1).alias("score"), F.lit(2).alias("num_comments"),
        F.lit(0.5).alias("subjectivity"), F.when(F.col("id") % 2 == 0, 0.6).otherwise(-0.6).alias("polarity"),
    )
    trained = training.train(cleaned, "id")
    assert trained.predictions.inputFiles() and all("/predictions-" in f for f in trained.predictions.inputFiles())
    assert "UDF" not in trained.confusion._jdf.queryExecution().executedPlan().toString()
    again = trained.model.transform(split_rows(training.labelled(cleaned), "id")[1])
    columns = ["id", "label", "features", "prediction"]
    assert sorted(map(str, trained.predictions.select(columns).collect())) == sorted(map(str, again.select(columns).collect()))
