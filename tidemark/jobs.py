"""Command line jobs: ``spark-submit tidemark/jobs.py JOB ...`` or ``python -m tidemark.jobs JOB ...``.

Tables are Parquet unless an option says otherwise. Word tables (``--lexicon`` with the columns ``word,
valence, subjectivity``) are Parquet folders or CSV files with a header.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.functions import text as tx
from tidemark.operators import prices, relation, rows, series, vectors, words
from tidemark.operators.lexicon import one_per_word
from tidemark.plans import headlines, training
from tidemark.plans.prices import RELATED
from tidemark.schemas import CLEAN_HEADLINE
from tidemark.session import as_dict, build_session, scratch
from tidemark.sources import arrays, files
from tidemark.streaming import headlines as streaming

# Years of the word pictures and words in each.
FIRST_YEAR, LAST_YEAR = 2008, 2019
PICTURE_WORDS = 200


IN_PROGRAM = 100_000  # words of a table that is kept in the program; a larger one is joined


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)


def is_large(lexicon: DataFrame) -> bool:
    return lexicon.limit(IN_PROGRAM + 1).count() > IN_PROGRAM


def as_words(lexicon: DataFrame, value: str) -> dict[str, float]:
    return as_dict(one_per_word(lexicon, value), "word", value, IN_PROGRAM)


def read_cleaned(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return files.read_clean_headlines(spark, args.cleaned, args.format, args.paired)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    """Clean, filter, date and score raw headlines."""
    raw = arrays.read_json_arrays(spark, args.raw) if args.multi_line else files.read_headlines(spark, args.raw)
    stops, profiles, lexicon = tx.default_stop_words(args.stop_languages.split(",")), tx.default_profiles(), read_lexicon(spark, args.lexicon)
    if is_large(lexicon):
        cleaned = headlines.clean_headlines_by_table(raw, stops, profiles, lexicon, args.language)
    else:
        values = [as_words(lexicon, v) for v in ("valence", "subjectivity")]
        cleaned = headlines.clean_headlines(raw, stops, profiles, *values, args.language)
    kept = cleaned if args.all_columns else headlines.clean_rows(cleaned)
    files.write_table(kept, args.out, args.format, compression=args.compression)


def picture_words(spark: SparkSession, args: argparse.Namespace) -> None:
    """Most frequent words per year over distinct headlines."""
    yearly = rows.years_between(read_cleaned(spark, args), "created_utc_iso", args.first_year, args.last_year)
    stops = words.PICTURE_STOP_WORDS + tx.default_stop_words(["english"])
    files.write_table(words.word_freq(yearly, "year", "title_clean", args.top, stops), args.out)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    """Daily sentiment of all and of the best-scored headlines, as one CSV file with date and both values."""
    result = headlines.daily_series_of_news(read_cleaned(spark, args))
    files.write_table(result.withColumnRenamed("created_utc_iso", "Date"), args.out, "csv", header=True, single_file=True)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fit and save the classifier; prints its measures."""
    cleaned = read_cleaned(spark, args)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CLEAN_HEADLINE.names]
    keyed = cleaned.withColumn("row_key", F.sha2(F.concat_ws("\x1f", *fields), 256))
    stage = vectors.CountVectors("words", "headline_vector", training.VECTOR_SIZE, min_count=args.min_count) if args.vectors == "counts" else None
    trained = training.train(keyed, "row_key", min_count=args.min_count, seed=args.seed, word_vectors=stage)
    training.save_model(trained.model, args.model)
    measures = trained.metrics.head()
    print(f"F1 {measures['f1']:g}, accuracy {measures['accuracy']:g}")


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    """Classify headlines as they are dropped into a folder."""
    stream, model, lexicon = files.stream_headlines(spark, args.drop), training.load_model(args.model), read_lexicon(spark, args.lexicon)
    inputs = (stream, model, args.checkpoint, tx.default_stop_words(args.stop_languages.split(",")))
    if is_large(lexicon):
        if args.sink != "parquet" or not args.out:
            raise ValueError("a lexicon of this size is joined per batch, which needs --sink parquet and --out")
        query = streaming.score_stream_by_table(*inputs, lexicon, args.out, args.seconds, args.available_now)
    else:
        sink = {"sink": args.sink, "path": args.out} if args.out else {"sink": args.sink}
        query = streaming.score_stream(*inputs, as_words(lexicon, "subjectivity"), args.seconds, available_now=args.available_now, **sink)
    query.stop()


def _bars(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    start = date.fromisoformat(args.start) if args.start else None
    end = date.fromisoformat(args.end) if args.end else None
    return files.read_prices(spark, args.csv, start, end, args.symbol_from_path)


def price_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Statistics per company and monthly means."""
    bars = _bars(spark, args)
    files.write_table(prices.price_stats(bars), f"{args.out}/stats")
    files.write_table(prices.monthly_mean(bars, "Open", "mean_open"), f"{args.out}/monthly_open")
    files.write_table(prices.monthly_mean(bars, "Volume", "mean_volume"), f"{args.out}/monthly_volume")


def decompose(spark: SparkSession, args: argparse.Namespace) -> None:
    """Trend, season, residual, difference and standardised residual of each company's price.

    The companies that cannot be decomposed are written with the reason to ``<out>-unfit``.
    """
    bars = _bars(spark, args)
    features = series.decomposed_features(bars, "Company", "Date", "Open", args.period)
    files.write_table(features, args.out, args.format, header=True)
    files.write_table(series.unfit(bars, "Company", "Date", "Open", args.period), f"{args.out.rstrip('/')}-unfit")


def relate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Correlations, histograms and densities of price features and sentiment, per company."""
    name = headlines.TOP_NEWS if args.news == "top" else headlines.ALL_NEWS
    related = [*RELATED[:2], f"standardized_sentiment_{args.news}_news"]
    scaled = series.standardized_daily(files.read_daily(spark, args.sentiment, [name]), "Date", name, related[2])
    features = files.read_features(spark, args.features) if args.format == "csv" else spark.read.parquet(args.features)
    joined = relation.join_by_date(features, scaled)
    files.write_table(joined, f"{args.out}/rows")
    stored = spark.read.parquet(f"{args.out}/rows")
    files.write_table(relation.pair_corr(stored, related, by="Company"), f"{args.out}/correlation")
    for col in related:
        files.write_table(relation.histogram(stored, col, by="Company"), f"{args.out}/histogram/{col}")
    for i, x in enumerate(related):
        for y in related[:i]:
            density = (relation.kde_binned if args.binned else relation.kde_grid)(stored, y, x, args.grid, by="Company")
            files.write_table(density, f"{args.out}/density/{y}-{x}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *positional):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    def cleaned_job(name, run, *positional):
        sub = job(name, run, "cleaned", *positional)
        sub.add_argument("--format", default="parquet", choices=["parquet", "json"])
        sub.add_argument("--paired", action="store_true", help="both scores are in one array")
        return sub

    def price_job(name, run):
        sub = job(name, run, "out")
        sub.add_argument("csv", nargs="+")
        sub.add_argument("--start")
        sub.add_argument("--end")
        sub.add_argument("--symbol-from-path", action="store_true")
        return sub

    sub = job("clean", clean, "raw", "out")
    sub.add_argument("--lexicon", required=True)
    sub.add_argument("--language", default="english")
    sub.add_argument("--stop-languages", default=",".join(tx.STOP_LANGUAGES))
    sub.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    sub.add_argument("--compression")
    sub.add_argument("--multi-line", action="store_true")
    sub.add_argument("--all-columns", action="store_true")

    sub = cleaned_job("words", picture_words, "out")
    sub.add_argument("--first-year", type=int, default=FIRST_YEAR)
    sub.add_argument("--last-year", type=int, default=LAST_YEAR)
    sub.add_argument("--top", type=int, default=PICTURE_WORDS)

    cleaned_job("daily", daily, "out")

    sub = cleaned_job("train", train, "model")
    sub.add_argument("--min-count", type=int, default=0)
    sub.add_argument("--seed", type=int, default=0)
    sub.add_argument("--vectors", default="skip-gram", choices=["skip-gram", "counts"], help="how word vectors are made")

    sub = job("score", score, "drop", "model", "checkpoint")
    sub.add_argument("--lexicon", required=True)
    sub.add_argument("--stop-languages", default=",".join(tx.STOP_LANGUAGES))
    sub.add_argument("--sink", default="console")
    sub.add_argument("--out")
    sub.add_argument("--seconds", type=int, default=streaming.STREAM_SECONDS)
    sub.add_argument("--available-now", action="store_true")

    price_job("prices", price_report)
    sub = price_job("decompose", decompose)
    sub.add_argument("--period", type=int, default=series.DECOMPOSE_PERIOD)
    sub.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="of the features")

    sub = job("relate", relate, "features", "sentiment", "out")
    sub.add_argument("--grid", type=int, default=relation.KDE_GRID)
    sub.add_argument("--binned", action="store_true", help="densities from binned points, with a bound on their error")
    sub.add_argument("--news", default="all", choices=["all", "top"], help="which daily series")
    sub.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="of the features")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    with scratch(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
