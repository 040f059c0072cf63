"""The command line jobs, end to end on small files."""

import json
import math

import numpy as np
import pytest

from tidemark import jobs


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("jobs")


@pytest.fixture(scope="module")
def cleaned(spark, folder):
    """Raw headlines over 50 days, cleaned by the first job."""
    raw = folder / "raw"
    raw.mkdir()
    texts = ["The markets are in a good win", "This is a bad loss for the city", "They were in the plain town", "Der Markt ist in der Stadt"]
    rows = [
        {"title": texts[i % 4], "score": i, "num_comments": i % 5, "url": "u", "domain": "d", "created_utc": 1577836800 + i * 18000, "id": str(i)}
        for i in range(240)
    ]
    rows += [{"title": None, "score": 1, "url": "u", "domain": "d", "created_utc": 1577836800}]
    rows += [{"title": "The good is in it", "score": 1, "url": "", "domain": "", "created_utc": 1577836800}]
    (raw / "page.json").write_text(json.dumps(rows))
    (raw / "last.json").write_text("[]")
    (folder / "lexicon.csv").write_text("word,valence,subjectivity\ngood,1.9,0.6\nbad,-2.5,0.9\n")
    jobs.main(
        ["clean", str(raw), str(folder / "cleaned"), "--lexicon", str(folder / "lexicon.csv"), "--stop-languages", "english"]
    )
    return str(folder / "cleaned")


def test_clean(spark, cleaned):
    rows = spark.read.parquet(cleaned)
    assert {r["title_clean"]: r["n"] for r in rows.groupBy("title_clean").count().withColumnRenamed("count", "n").collect()} == {
        "markets good win": 60, "bad loss city": 60, "plain town": 60,
    }
    scores = {r["title_clean"]: r["polarity"] for r in rows.collect()}
    assert scores["markets good win"] == pytest.approx(1.9 / math.sqrt(1.9**2 + 15))
    assert scores["plain town"] == 0


def test_words(spark, folder, cleaned):
    jobs.main(["words", cleaned, str(folder / "words"), "--top", "2"])
    assert spark.read.parquet(str(folder / "words")).isEmpty()  # 2020 is after the years drawn by default
    jobs.main(["words", cleaned, str(folder / "words"), "--top", "2", "--last-year", "2020"])
    got = spark.read.parquet(str(folder / "words")).orderBy("place").collect()
    assert [(r["year"], r["word"], r["n"]) for r in got] == [(2020, "bad", 1), (2020, "city", 1)]


def test_daily_decompose_and_relate(spark, folder, cleaned):
    jobs.main(["daily", cleaned, str(folder / "daily")])
    sentiment = spark.read.option("header", True).csv(str(folder / "daily"))
    assert sentiment.columns == ["Date", "avg_sentiment_all_news", "avg_sentiment_top_news"] and sentiment.count() == 50

    rng = np.random.default_rng(0)
    stocks = folder / "stocks"
    stocks.mkdir()
    days = np.datetime64("2020-01-01") + np.arange(100)
    for symbol in ("NKE", "XOM"):
        lines = [f"{d},{p:.4f},{v}" for d, p, v in zip(days, rng.uniform(20, 30, 100), rng.integers(1, 9, 100))]
        (stocks / f"{symbol}.csv").write_text("\n".join(["Date,Open,Volume", *lines]))
    files = [str(p) for p in stocks.glob("*.csv")]
    jobs.main(["prices", str(folder / "report"), *files, "--symbol-from-path"])
    assert spark.read.parquet(str(folder / "report" / "stats")).count() == 2
    assert spark.read.parquet(str(folder / "report" / "monthly_open")).count() == 8
    (stocks / "NEW.csv").write_text("Date,Open,Volume\n2020-01-01,5.0,1\n")
    jobs.main(["decompose", str(folder / "features"), *files, str(stocks / "NEW.csv"), "--symbol-from-path"])
    unfit = spark.read.parquet(str(folder / "features-unfit")).collect()
    assert [tuple(r) for r in unfit] == [("NEW", "fewer than two periods")]
    assert spark.read.parquet(str(folder / "features")).groupBy("Company").count().collect()[0]["count"] == 72

    jobs.main(["relate", str(folder / "features"), str(folder / "daily"), str(folder / "related"), "--grid", "5"])
    related = spark.read.parquet(str(folder / "related" / "rows")).toPandas()
    assert related.groupby("Company").size().to_dict() == {"NKE": 36, "XOM": 36}
    corr = {(r["Company"], r["x"], r["y"]): r["r"] for r in spark.read.parquet(str(folder / "related" / "correlation")).collect()}
    for company, part in related.groupby("Company"):
        want = np.corrcoef(part.difference, part.standardized_residual)[0][1]
        assert corr[company, "difference", "standardized_residual"] == pytest.approx(want)
    density = folder / "related" / "density"
    assert len(list(density.iterdir())) == 3
    assert all(spark.read.parquet(str(d)).count() == 50 for d in density.iterdir())
    bins = spark.read.parquet(str(folder / "related" / "histogram" / "difference"))
    assert bins.groupBy("Company").sum("n").collect()[0][1] == 36

    jobs.main(["relate", str(folder / "features"), str(folder / "daily"), str(folder / "top"), "--grid", "2", "--news", "top"])
    assert "standardized_sentiment_top_news" in spark.read.parquet(str(folder / "top" / "rows")).columns


def test_features_as_csv(spark, folder, cleaned):
    """The same relation from features in CSV as from those in Parquet."""
    stocks = [str(p) for p in (folder / "stocks").glob("[NX]*M.csv")] + [str(folder / "stocks" / "NKE.csv")]
    jobs.main(["decompose", str(folder / "features-csv"), *stocks, "--symbol-from-path", "--format", "csv"])
    text = next((folder / "features-csv").glob("*.csv")).read_text()
    assert text.startswith("Company,Date,")
    jobs.main(["relate", str(folder / "features-csv"), str(folder / "daily"), str(folder / "related-csv"), "--grid", "2", "--format", "csv", "--binned"])
    one, other = (spark.read.parquet(str(folder / d / "correlation")).orderBy("Company", "x", "y").collect() for d in ("related", "related-csv"))
    assert [tuple(r)[:3] for r in one] == [tuple(r)[:3] for r in other]
    assert [r["r"] for r in one] == pytest.approx([r["r"] for r in other])
    density = spark.read.parquet(str(next((folder / "related-csv" / "density").iterdir())))
    assert "bound" in density.columns and density.count() == 8


def test_staged_tables_of_a_job_go(spark, folder, cleaned):
    from pathlib import Path

    from tidemark.session import scratch, shared_folder, staged

    at = Path(shared_folder(spark).removeprefix("file:")) / spark.sparkContext.applicationId
    kept = staged(spark.range(3), "kept")
    before = set(at.iterdir())
    jobs.main(["daily", cleaned, str(folder / "daily-again")])
    assert set(at.iterdir()) == before and kept.count() == 3
    with pytest.raises(KeyError), scratch(spark):
        staged(spark.range(3), "gone")
        raise KeyError
    assert set(at.iterdir()) == before


def test_a_lexicon_above_the_bound_is_joined(spark, folder, cleaned, monkeypatch):
    """The same rows and predictions as with the table in the program."""
    monkeypatch.setattr(jobs, "IN_PROGRAM", 1)
    jobs.main(["clean", str(folder / "raw"), str(folder / "joined"), "--lexicon", str(folder / "lexicon.csv"), "--stop-languages", "english", "--multi-line"])
    one, other = (spark.read.parquet(p) for p in (cleaned, str(folder / "joined")))
    assert one.columns == other.columns and one.count() == other.count()
    round_ = lambda df: sorted((r["title"], r["score"], round(r["polarity"], 12), round(r["subjectivity"], 12)) for r in df.collect())
    assert round_(one) == round_(other)
    jobs.main(["train", cleaned, str(folder / "model-counts"), "--vectors", "counts"])
    drop = folder / "drop-large"
    drop.mkdir()
    (drop / "1.json").write_text(json.dumps([{"title": "A bad loss for the city"}, {"title": None}, {"title": "The of"}]))
    score = ["score", str(drop), str(folder / "model-counts"), str(folder / "checkpoint-large"), "--lexicon", str(folder / "lexicon.csv")]
    with pytest.raises(ValueError, match="parquet"):
        jobs.main([*score, "--available-now"])
    jobs.main([*score, "--sink", "parquet", "--out", str(folder / "scored-large"), "--available-now"])
    got = {r["title"]: r["prediction"] for r in spark.read.parquet(str(folder / "scored-large")).collect()}
    assert set(got) == {"A bad loss for the city", "The of"} and got["A bad loss for the city"] == 0.0


def test_train_and_score(spark, folder, cleaned, capsys):
    model = str(folder / "model")
    jobs.main(["train", cleaned, model])
    assert "accuracy 1" in capsys.readouterr().out
    drop = folder / "drop"
    drop.mkdir()
    (drop / "1.json").write_text(json.dumps([{"title": "A bad loss for the city"}, {"title": None}]))
    jobs.main(
        ["score", str(drop), model, str(folder / "checkpoint"), "--lexicon", str(folder / "lexicon.csv"),
         "--sink", "parquet", "--out", str(folder / "scored"), "--available-now"]
    )
    got = spark.read.parquet(str(folder / "scored")).collect()
    assert [(r["title"], r["prediction"]) for r in got] == [("A bad loss for the city", 0.0)]
