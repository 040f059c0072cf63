"""The driver's tables in the roles the jobs expect, in Spark and in SQL.

Daily price bars come from ``orders`` (priority as company), headlines from ``documents`` dated by the
order of the same key or, without one, by their own, the second daily series from ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Word tables of the checks. The invented prose has real function words, so these stand in for lexicons.
PROFILES = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "with", "be", "as", "by", "are", "this", "at", "from", "an"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "pour", "est", "qui", "dans", "par", "pas", "au", "sur", "avec"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "sich", "mit", "auf", "des", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un", "no", "con", "su", "una", "es", "para", "al", "lo"],
}
STOPS = sorted({w for words in PROFILES.values() for w in words} | {"say"})
VALENCES = {"th": 1.9, "er": -2.5, "re": 0.8, "ha": 3.1, "nd": -1.2, "he": 0.4, "or": -0.7, "ou": 2.2, "st": -3.0, "ing": 1.1, "eau": 1.5, "ch": -0.9}
WEIGHTS = {"th": 0.6, "er": 0.9, "re": 0.1, "ha": 1.0, "nd": 0.3, "he": 0.25, "or": 0.75, "ou": 0.5, "st": 0.85, "ing": 0.2, "eau": 0.4, "ch": 0.7}


# Prices and sentiments are converted at this rate. It has no short decimal form, so means are not halfway
# between two rounded values, where the two engines may round apart.
RATE = 0.7071067811865476
PRICE = f"o_totalprice * CAST({RATE / 1000!r} AS DOUBLE)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as scored rows: ``day, score, polarity`` (the number in ``props``, converted)."""
    return table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.col("ts").cast("date").alias("day"),
        F.col("value").alias("score"),
        (F.regexp_extract("props", "[0-9]+", 0).cast("double") * RATE).alias("polarity"),
    )


DAY_EVENTS = f"""
    SELECT event_id, event_type, CAST(ts AS DATE) AS day, value AS score,
           CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) * CAST({RATE!r} AS DOUBLE) AS polarity
    FROM events
"""


def orders(spark: SparkSession, sf: str) -> DataFrame:
    price = (F.col("o_totalprice") * (RATE / 1000)).alias("price")
    return table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", price)


def bars(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).groupBy(
        F.col("o_orderpriority").alias("Company"), F.col("o_orderdate").cast("date").alias("Date")
    ).agg(F.avg("price").alias("Open"), F.count(F.lit(1)).cast("double").alias("Volume"))


BARS = f"""
    SELECT o_orderpriority AS Company, CAST(o_orderdate AS DATE) AS Date,
           avg({PRICE}) AS Open, CAST(count(*) AS DOUBLE) AS Volume
    FROM orders GROUP BY 1, 2
"""


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"),
        ((F.col("l_discount") - F.col("l_tax")) * RATE).alias("avg_sentiment_all_news"),
    )


SENTIMENT = f"""
    SELECT CAST(l_shipdate AS DATE) AS Date, (l_discount - l_tax) * CAST({RATE!r} AS DOUBLE) AS avg_sentiment_all_news FROM lineitem
"""


def headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the layout of raw headlines."""
    docs, orders = table(spark, sf, "documents"), table(spark, sf, "orders")
    own = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("doc_id") % 2000).cast("int"))
    day = F.coalesce(F.col("o_orderdate").cast("date"), own)
    return docs.join(orders.select("o_orderkey", "o_orderdate"), F.col("doc_id") == F.col("o_orderkey"), "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("title"),
        F.col("source").alias("domain"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("n_chars").alias("score"),
        F.col("doc_id").alias("num_comments"),
        (F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.col("doc_id")).alias(
            "created_utc"
        ),
        day.alias("day"),
    )


HEADLINES = """
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS title, source AS domain, 'doc/' || doc_id AS url,
           n_chars AS score, doc_id AS num_comments,
           date_diff('day', DATE '1970-01-01', day) * 86400 + doc_id AS created_utc, day
    FROM (SELECT documents.*, coalesce(CAST(o_orderdate AS DATE), DATE '1995-01-01' + CAST(doc_id % 2000 AS INTEGER)) AS day
          FROM documents LEFT JOIN orders ON doc_id = o_orderkey)
"""


def text_of(col: str) -> str:
    """SQL text of a date column."""
    return f"strftime({col}, '%Y-%m-%d')"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def word_values(values: dict[str, float]) -> str:
    return ", ".join(f"('{w}', CAST({v} AS DOUBLE))" for w, v in values.items())


def tokens_sql(col: str) -> str:
    """SQL for the token array of a text column."""
    return rf"string_split(lower(regexp_replace({col}, '[^\s\p{{L}}\p{{N}}]+', '', 'g')), ' ')"


def kept_sql(tokens: str) -> str:
    return f"list_filter({tokens}, lambda w: w NOT IN ({quoted(STOPS)}))"


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    """Round for the comparison; adding zero turns a negative zero into zero."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in cols})


def day_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})
