"""Files written from the tables and read back, and streams over such files."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from checks import models
from checks.tables import BARS, HEADLINES, STOPS, WEIGHTS, bars, day_text, headlines, kept_sql, rounded, table, tokens_sql
from checks.texts import hits_sql
from tidemark import schemas
from tidemark.operators import skipgram, wordtable
from tidemark.plans import training
from tidemark.session import new_folder, scratch, shuffles_end
from tidemark.sources import arrays, files, onefile, paged, pages, prices as mixed
from tidemark.streaming import bounded, headlines as streaming

# The workers of the checks may run where the package is not installed.
for module in (arrays, mixed, onefile, skipgram, wordtable):
    cloudpickle.register_pickle_by_value(module)
cloudpickle.register_pickle_by_value(paged)
cloudpickle.register_pickle_by_value(pages)

LATEST_BAR = "2000-06-30"


def _raw(spark, sf):
    return headlines(spark, sf).drop("day")


def json_scan(spark, sf):
    """Raw headlines with all their fields, most of them missing in the file."""
    path = new_folder(spark, "raw-json")
    files.write_table(_raw(spark, sf), path, "json")
    rows = files.read_headlines(spark, path)
    return rows.select("id", "title", "domain", "url", "score", "num_comments", "created_utc").where(F.col("author").isNull())


def page_scan(spark, sf):
    """Pages as arrays, one per line."""
    path = new_folder(spark, "pages")
    rows = _raw(spark, sf).select("created_utc", "id", "title", "score")
    pages.write_pages(rows, path, ["created_utc", "id"], 50)
    return files.read_headlines(spark, path).select("created_utc", "id", "title", "score")


def page_array_scan(spark, sf):
    """One array in one file, its objects broken over lines, read in ranges of 64 KB."""
    path = new_folder(spark, "array") + ".json"
    fields = ("created_utc", "id", "title", "score")
    broken = _raw(spark, sf).select(F.concat(F.to_json(F.struct(*fields), {"pretty": "true"}), F.lit(",")).alias("value"))
    onefile.write_one_text(broken, path, "[\n", '{"author": "nobody"}\n]\n')
    rows = arrays.read_json_arrays(spark, path, split_bytes=64 << 10)
    return rows.where(F.col("author").isNull()).select(*fields)


def paired_scan(spark, sf):
    """Cleaned headlines whose two scores are in one array."""
    path = new_folder(spark, "paired")
    paired = _raw(spark, sf).select(
        F.col("title").alias("title_clean"),
        "title",
        F.lit("2019-11-01T07:00:34").alias("created_utc_iso"),
        F.array(F.col("score") / 1024, F.col("num_comments") / 64).alias("polarity_subjectivity"),
        "score",
        "num_comments",
    )
    files.write_table(paired, path, "json", compression="gzip")
    rows = files.read_clean_headlines(spark, path, "json", paired=True)
    return day_text(rows.drop("title_clean"), "created_utc_iso")


def csv_sink(spark, sf):
    """Compressed CSV without a header, read by position."""
    path = new_folder(spark, "csv")
    rows = _raw(spark, sf).select("id", "domain", "score", F.lit("one, \"two\"").alias("quoted"))
    files.write_table(rows, path, "csv", compression="gzip")
    return spark.read.schema("id string, domain string, score bigint, quoted string").csv(path)


def price_files(spark, sf):
    """Price bars as CSV, one folder per company, read for a range of days."""
    path = new_folder(spark, "bars")
    files.write_table(bars(spark, sf), path, "csv", header=True, partition_by=["Company"])
    read = files.read_prices(spark, path, end=F.lit(LATEST_BAR).cast("date"))
    return rounded(day_text(read, "Date"), 6, "Open")


def series_file(spark, sf):
    """A small daily series in a single CSV file."""
    path = new_folder(spark, "series")
    daily = bars(spark, sf).groupBy("Date").agg(F.sum("Volume").alias("Volume"))
    files.write_table(daily, path, "csv", header=True, single_file=True)
    return day_text(files.read_daily(spark, path, ["Volume"]), "Date")


def ordered_file(spark, sf):
    """Every order in one compressed file, by day and key, as it stands there."""
    path = f"{new_folder(spark, 'orders')}.csv.gz"
    onefile.write_one_file(table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), path, ["o_orderdate", "o_orderkey"], compressed=True)
    lines = spark.read.option("header", True).csv(path).select("o_orderkey", F.monotonically_increasing_id().alias("place"))
    return lines.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "place")


def _mixed_bars(spark, sf):
    """Two kinds of files, with other columns in another order and a date that can't be read for each fifth day."""
    path = new_folder(spark, "mixed-bars")
    rows = bars(spark, sf)
    day = F.when(F.dayofmonth("Date") % 5 == 0, F.concat(F.lit("on "), F.col("Date").cast("string"))).otherwise(F.col("Date").cast("string"))
    even = F.month("Date") % 2 == 0
    one = rows.where(even).select(day.alias("Date"), "Open", "Volume", "Company")
    other = rows.where(~even).select("Company", F.lit("note, with a comma").alias("Remark"), "Volume", day.alias("Date"))
    files.write_table(one, f"{path}/a", "csv", header=True)
    files.write_table(other, f"{path}/b", "csv", header=True, compression="gzip")
    return mixed.read_mixed_prices(spark, [f"{path}/a", f"{path}/b"])


def mixed_price_files(spark, sf):
    return rounded(day_text(_mixed_bars(spark, sf).bars, "Date"), 6, "Open")


def rejected_prices(spark, sf):
    """Rows that are no bars, per kind of file and reason."""
    rejected = _mixed_bars(spark, sf).rejected
    return rejected.groupBy(F.regexp_extract("file", "/([ab])/[^/]*$", 1).alias("kind"), "reason").agg(F.count(F.lit(1)).alias("n"))


SLICE = 6 * 3600  # seconds of the feed's slices
KEY = ("second", "event_id")


def _events(spark, sf):
    return table(spark, sf, "events").select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("second"), "event_id")


def _feed(name: str, path: str):
    return paged.paged_source(name, "second bigint, event_id bigint", *pages.sliced_feed(path, KEY, SLICE))


def paged_feed(spark, sf):
    """All events through the paged source, six hours of them per task."""
    path = new_folder(spark, "feed")
    pages.write_slices(_events(spark, sf), path, KEY, SLICE)
    spark.dataSource.register(_feed("event_feed", path))
    start, end = _events(spark, sf).agg(F.min("second"), F.max("second") + 1).head()
    return spark.read.format("event_feed").options(start=start, end=end, slice=SLICE, size=500).load()


OVERLAP = 3600


def cursor_feed(spark, sf):
    """All events as a stream that is stopped, restarted and shown some rows late, each once.

    The feed first has the older half of the events without some that are up to an hour old; these and the newer half
    follow while the stream is down.
    """
    path, out, checkpoint = (new_folder(spark, n) for n in ("feed", "followed", "checkpoint"))
    events = _events(spark, sf)
    low, high = events.agg(F.min("second"), F.max("second")).head()
    middle = (low + high) // 2
    late = (F.col("second") > middle - OVERLAP) & (F.col("event_id") % 3 == 0) & (F.col("second") < middle - 1)
    older = F.col("second") <= middle
    spark.dataSource.register(_feed("event_stream", path))
    for shown in (older & ~late, ~older | late):
        pages.write_slices(events.where(shown), path, KEY, SLICE)
        rows = paged.follow(spark, "event_stream", KEY, OVERLAP, start=low, slice=SLICE, size=500)
        query = streaming.start(rows, checkpoint, "parquet", out)
        query.processAllAvailable()
        query.stop()
    return spark.read.parquet(out)


def _stream(spark, sf, *extra):
    """Headlines dropped into a folder, as a stream."""
    path = new_folder(spark, "drop")
    files.write_table(_raw(spark, sf).select("title", "score", "num_comments", *extra), path, "json")
    schema = T.StructType([*schemas.STREAM_HEADLINE, *[T.StructField(name, T.StringType()) for name in extra]])
    return files.stream_headlines(spark, path, schema, max_files=2)


def _drained(query, spark, path):
    query.awaitTermination()
    return spark.read.parquet(path)


def stream_prepare(spark, sf):
    path, checkpoint = new_folder(spark, "prepared"), new_folder(spark, "checkpoint")
    prepared = streaming.prepare(_stream(spark, sf), STOPS, WEIGHTS)
    query = streaming.start(prepared, checkpoint, "parquet", path, available_now=True)
    return rounded(_drained(query, spark, path).select("num_comments", "title_clean", "subjectivity", "label"), 8, "subjectivity")


def batch_prepare(spark, sf):
    prepared = streaming.prepare(_raw(spark, sf).select("title", "score", "num_comments"), STOPS, WEIGHTS)
    return rounded(prepared.select("num_comments", "title_clean", "subjectivity", "label"), 8, "subjectivity")


def stream_lexicon_join(spark, sf):
    path, checkpoint = new_folder(spark, "scored"), new_folder(spark, "checkpoint")
    lexicon = spark.createDataFrame(list(WEIGHTS.items()), "word string, valence double")
    query = streaming.start_large_lexicon(_stream(spark, sf, "id"), "id", lexicon, path, checkpoint, STOPS, mode="mean")
    return rounded(_drained(query, spark, path).select("id", "score"), 8, "score")


def bounded_stream(spark, sf):
    """A stream that is stopped after its first batch and goes on from its checkpoint, each row once."""
    path, checkpoint, drop = (new_folder(spark, n) for n in ("bounded", "checkpoint", "drop"))
    rows = _raw(spark, sf).select("id", "title", "score").repartition(6, "id")
    files.write_table(rows, drop, "json")
    schema = T.StructType([rows.schema[n] for n in ("id", "title", "score")])
    for limit in (1, None):
        stream = files.stream_headlines(spark, drop, schema, max_files=1)
        bounded.run_for(bounded.write_batches(stream, path, checkpoint, available_now=limit is None), 600, batches=limit)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def stream_page_files(spark, sf):
    path, checkpoint = new_folder(spark, "page-files"), new_folder(spark, "checkpoint")
    streaming.write_page_files(_stream(spark, sf), path, checkpoint, available_now=True).awaitTermination()
    return files.read_headlines(spark, path, schemas.STREAM_HEADLINE).select("title", "score", "num_comments")


def stream_score(spark, sf):
    """A model trained, saved, loaded and applied to a stream."""
    folder, path = new_folder(spark, "model"), new_folder(spark, "predicted")
    training.save_model(models.trained(spark, sf).model, folder)
    query = streaming.score_stream(
        _stream(spark, sf),
        training.load_model(folder),
        new_folder(spark, "checkpoint"),
        STOPS,
        WEIGHTS,
        sink="parquet",
        path=path,
        available_now=True,
    )
    return _drained(query, spark, path).select("title", "prediction")


def stream_score_differences(spark, sf):
    """Rows that the model scored on a stream, and how many differ from its scores of the same table, either way."""
    path, scores, model = new_folder(spark, "predicted"), new_folder(spark, "batch-scores"), models.trained(spark, sf).model
    raw = _raw(spark, sf).select("title", "score", "num_comments")
    sink = {"sink": "parquet", "path": path, "available_now": True, "compression": "zstd"}
    with scratch(spark), shuffles_end(spark):  # the files that the stream has read go when it ends
        streaming.score_stream(_stream(spark, sf), model, new_folder(spark, "checkpoint"), STOPS, WEIGHTS, **sink)
    streamed = spark.read.parquet(path).select("title", "prediction")
    batch = streaming.score_batch(raw, model, scores, STOPS, WEIGHTS)
    signed = streamed.withColumn("sign", F.lit(1)).unionByName(batch.withColumn("sign", F.lit(-1)))
    off = signed.groupBy("title", "prediction").agg(F.sum("sign").alias("off"))
    differ = [F.coalesce(F.sum(F.when(off, F.abs("off"))), F.lit(0)) for off in (F.col("off") > 0, F.col("off") < 0)]
    found = [streamed.count(), 0, 0]
    with shuffles_end(spark):  # a quarter of the titles is shuffled at a time
        for k in range(4):
            more, fewer = off.where(F.pmod(F.xxhash64("title"), F.lit(4)) == k).agg(*differ).head()
            found = [found[0], found[1] + more, found[2] + fewer]
    return spark.createDataFrame([tuple(found)], "scored bigint, only_streamed bigint, only_batch bigint")


QUERIES = {
    f.__name__: f
    for f in (
        json_scan, page_scan, page_array_scan, paired_scan, csv_sink, price_files, series_file,
        ordered_file, mixed_price_files, rejected_prices, bounded_stream, paged_feed, cursor_feed, stream_prepare,
        batch_prepare, stream_lexicon_join, stream_page_files, stream_score,
        stream_score_differences,
    )
}

_WORDS = f"SELECT id, {kept_sql(tokens_sql('title'))} AS words FROM ({HEADLINES})"
_PREPARED = f"""
    SELECT num_comments, array_to_string({kept_sql(tokens_sql('title'))}, ' ') AS title_clean,
           round(a, 8) + 0.0 AS subjectivity, 0::DOUBLE AS label
    FROM ({HEADLINES}) h JOIN ({hits_sql(_WORDS, WEIGHTS)}) w ON h.id = w.id
"""

SQL = {
    "json_scan": f"SELECT id, title, domain, url, score, num_comments, created_utc FROM ({HEADLINES})",
    "page_scan": f"SELECT created_utc, id, title, score FROM ({HEADLINES})",
    "page_array_scan": f"SELECT created_utc, id, title, score FROM ({HEADLINES})",
    "paired_scan": f"""
        SELECT title, '2019-11-01' AS created_utc_iso, CAST(CAST(score / 1024 AS FLOAT) AS DOUBLE) AS polarity,
               CAST(CAST(num_comments / 64 AS FLOAT) AS DOUBLE) AS subjectivity, score, num_comments FROM ({HEADLINES})
    """,
    "csv_sink": f"SELECT id, domain, score, 'one, \"two\"' AS quoted FROM ({HEADLINES})",
    "price_files": f"""
        SELECT Company, strftime(Date, '%Y-%m-%d') AS Date, round(Open, 6) + 0.0 AS Open, Volume FROM ({BARS})
        WHERE Date <= DATE '{LATEST_BAR}'
    """,
    "ordered_file": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders",
    "mixed_price_files": f"""
        SELECT Company, strftime(Date, '%Y-%m-%d') AS Date, CASE WHEN month(Date) % 2 = 0 THEN round(Open, 6) + 0.0 END AS Open, Volume FROM ({BARS})
        WHERE day(Date) % 5 <> 0
    """,
    "rejected_prices": f"""
        SELECT CASE WHEN month(Date) % 2 = 0 THEN 'a' ELSE 'b' END AS kind, 'no date' AS reason, count(*) AS n FROM ({BARS})
        WHERE day(Date) % 5 = 0 GROUP BY 1
    """,
    "bounded_stream": f"SELECT id, title, score FROM ({HEADLINES})",
    "series_file": f"SELECT strftime(Date, '%Y-%m-%d') AS Date, sum(Volume) AS Volume FROM ({BARS}) GROUP BY 1",
    "paged_feed": "SELECT CAST(epoch_us(ts) // 1000000 AS BIGINT) AS second, event_id FROM events",
    "cursor_feed": "SELECT CAST(epoch_us(ts) // 1000000 AS BIGINT) AS second, event_id FROM events",
    "stream_prepare": _PREPARED,
    "batch_prepare": _PREPARED,
    "stream_lexicon_join": f"SELECT id, round(a, 8) + 0.0 AS score FROM ({hits_sql(_WORDS, WEIGHTS)})",
    "stream_score_differences": "SELECT count(*) AS scored, CAST(0 AS BIGINT) AS only_streamed, CAST(0 AS BIGINT) AS only_batch FROM documents WHERE text IS NOT NULL",
    "stream_page_files": f"SELECT title, score, num_comments FROM ({HEADLINES})",
}
