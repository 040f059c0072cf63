"""Cleaning, filtering, counting and scoring of text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import (
    HEADLINES, PROFILES, STOPS, VALENCES, WEIGHTS, day_text, headlines, kept_sql, quoted, rounded, table,
    tokens_sql, word_values,
)
from tidemark.functions import dates, scoring, text as tx
from tidemark.operators import frequent, language, lexicon, rows, vectors, words
from tidemark.plans import headlines as plans
from tidemark.session import as_dict

FIRST_YEAR, LAST_YEAR = 1996, 1999
TOP_WORDS = 20
CHUNK = 40


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.tokens(F.col("text")).alias("words"))


def _labelled(spark, sf):
    return _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "text", "quality", "toxic"
    )


def notnull_filter(spark, sf):
    return rows.require_non_null(_labelled(spark, sf), ["text", "quality", "toxic"])


def drop_any_null(spark, sf):
    return rows.drop_incomplete(_labelled(spark, sf)).select("doc_id", "quality")


def nonempty_or_filter(spark, sf):
    cleaned = rows.clean_text(_docs(spark, sf), "text", stop_words=STOPS)
    return rows.require_non_empty(cleaned, "title_clean", ["source", "lang"]).select("doc_id", "title_clean")


def year_range(spark, sf):
    kept = rows.years_between(headlines(spark, sf), "day", FIRST_YEAR, LAST_YEAR)
    return kept.select("id", "year")


def date_parts(spark, sf):
    days = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return day_text(rows.date_parts(days, "day").drop("day"), "month_year")


def parse_dates(spark, sf):
    """Dates to text and back; the status column stands for unreadable text."""
    text = table(spark, sf, "orders").select(
        "o_orderkey", F.array(F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")).alias("both")
    )
    read = text.select("o_orderkey", F.explode("both").alias("raw")).withColumn("day", dates.parse_date(F.col("raw")))
    return read.select("o_orderkey", "raw", F.coalesce(F.date_format("day", "yyyy/MM/dd"), F.lit("unreadable")).alias("day"))


def epoch_iso(spark, sf):
    return headlines(spark, sf).select("id", dates.epoch_to_iso(F.col("created_utc")).alias("iso"))


def union_files(spark, sf):
    parts = [
        _docs(spark, sf).select(F.col("doc_id").alias("id"), "text"),
        table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "text"),
        table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
    ]
    return rows.union_all(parts)


def shaped_columns(spark, sf):
    """Projection, renaming, derived and constant columns."""
    shaped = headlines(spark, sf).select(F.col("id").alias("headline_id"), "score", "num_comments")
    return shaped.withColumns({"attention": F.col("score") + F.col("num_comments"), "label": F.lit(0.0)})


def split_pair(spark, sf):
    pairs = rows.split_pair(table(spark, sf, "embeddings"), "embedding", "first", "second")
    return pairs.select("vec_id", "first", "second")


def clean_text(spark, sf):
    cleaned = rows.clean_text(_docs(spark, sf), "text", stop_words=STOPS)
    return cleaned.select("doc_id", "title_clean")


def clean_turns(spark, sf):
    cleaned = rows.clean_text(table(spark, sf, "conversations"), "text", "clean")
    return cleaned.select("conv_id", "turn", "clean")


def _yearly(spark, sf):
    cleaned = rows.clean_text(headlines(spark, sf), "title", stop_words=STOPS)
    return cleaned.withColumn("year", F.year("day"))


def group_word_freq(spark, sf):
    return words.word_freq(_yearly(spark, sf), "year", "title_clean", TOP_WORDS).select("year", "word", "n", "place")


def words_top_2000(spark, sf):
    """More words than Spark's own limit per task and group allows for."""
    return words.word_freq(_yearly(spark, sf), "year", "title_clean", 2000).select("year", "word", "n", "place")


def _repeated_lexicon(spark):
    """Some words are listed twice, with other values."""
    again = [(w, 3 * v) for w, v in VALENCES.items() if v > 1]
    return spark.createDataFrame([*VALENCES.items(), *again], "word string, valence double")


def polarity_repeated(spark, sf):
    """A word listed twice has the mean of its values, in the join and in the program's table alike."""
    table = _repeated_lexicon(spark)
    known = as_dict(lexicon.one_per_word(table, "valence"), "word", "valence")
    joined = lexicon.lexicon_score(_tokens(spark, sf), "doc_id", "words", table, out="joined")
    inline = _tokens(spark, sf).select("doc_id", scoring.polarity(F.col("words"), known).alias("inline"))
    return rounded(joined.join(inline, "doc_id"), 8, "joined", "inline")


def distinct_titles_joined(spark, sf):
    return words.joined_titles(_yearly(spark, sf), "year", "title_clean", CHUNK)


def idf_table(spark, sf):
    return rounded(words.idf_table(_tokens(spark, sf), "words", 5), 8, "idf")


def pmi_table(spark, sf):
    """Mutual information of words at most two places apart that occur twenty times."""
    counts = vectors.cooccurrences(_tokens(spark, sf), "words", 2, 20)
    return rounded(vectors.ppmi(counts), 6, "value")


def _spark_lexicon(spark, values):
    return spark.createDataFrame(list(values.items()), "word string, valence double")


def polarity(spark, sf):
    scored = _tokens(spark, sf).select("doc_id", scoring.polarity(F.col("words"), VALENCES).alias("score"))
    return rounded(scored, 8, "score")


def polarity_join(spark, sf):
    scores = lexicon.lexicon_score(_tokens(spark, sf), "doc_id", "words", _spark_lexicon(spark, VALENCES))
    return rounded(scores, 8, "score")


def polarity_large_join(spark, sf):
    """A lexicon of 150,000 further words, none of which a token can be."""
    unlisted = spark.range(150_000).select(F.format_string("no-%d", "id").alias("word"), F.lit(1.0).alias("valence"))
    scores = lexicon.lexicon_score(
        _tokens(spark, sf), "doc_id", "words", _spark_lexicon(spark, VALENCES).unionByName(unlisted)
    )
    return rounded(scores, 8, "score")


def polarity_label(spark, sf):
    scored = _tokens(spark, sf).withColumn("score", scoring.polarity(F.col("words"), VALENCES))
    return scored.select("doc_id", scoring.polarity_label(F.col("score")).alias("label"))


def subjectivity(spark, sf):
    scored = _tokens(spark, sf).select("doc_id", scoring.subjectivity(F.col("words"), WEIGHTS).alias("score"))
    return rounded(scored, 8, "score")


def subjectivity_join(spark, sf):
    scores = lexicon.lexicon_score(
        _tokens(spark, sf), "doc_id", "words", _spark_lexicon(spark, WEIGHTS), mode="mean"
    )
    return rounded(scores, 8, "score")


def _profiles(spark):
    return spark.createDataFrame([(lang, w) for lang, ws in PROFILES.items() for w in ws], "lang string, word string")


def language_profile(spark, sf):
    return lexicon.language_profile(_tokens(spark, sf), "doc_id", "words", _profiles(spark))


def likely_language(spark, sf):
    lang = scoring.likely_language(F.col("words"), PROFILES)
    return _tokens(spark, sf).select("doc_id", F.coalesce(lang, F.lit("none")).alias("lang"))


def english_only_filter(spark, sf):
    english = scoring.likely_language(F.col("words"), PROFILES) == "en"
    return _tokens(spark, sf).where(english).select("doc_id")


def language_truth(spark, sf):
    """How the found language agrees with the given one."""
    found = F.coalesce(scoring.likely_language(tx.tokens(F.col("text")), PROFILES), F.lit("none"))
    return _docs(spark, sf).groupBy("lang", found.alias("found")).agg(F.count(F.lit(1)).alias("n"))


def _judged(spark, sf):
    """Languages of the documents held back, by grams of the others."""
    docs = _docs(spark, sf).select("doc_id", "lang", tx.tokens(F.col("text")).alias("words"))
    learnt, held_back = rows.split_rows(docs, "doc_id")
    langs, profiles = language.learn(learnt, "words", "lang")
    found = language.most_likely(held_back, "doc_id", "words", langs, profiles).withColumnRenamed("lang", "found")
    return held_back.select("doc_id", "lang").join(found, "doc_id", "left").withColumn("found", F.coalesce("found", F.lit("none")))


def gram_language(spark, sf):
    return _judged(spark, sf).select("doc_id", "found")


def gram_language_truth(spark, sf):
    """How the language found by grams agrees with the given one, on documents that nothing was learnt from."""
    return _judged(spark, sf).groupBy("lang", "found").agg(F.count(F.lit(1)).alias("n"))


def frequent_words_2000(spark, sf):
    """The rows of ``words_top_2000`` without a shuffle of every word."""
    return frequent.frequent_words(_yearly(spark, sf), "year", "title_clean", 2000).select("year", "word", "n", "place")


def _clean(spark, sf):
    return plans.clean_headlines(headlines(spark, sf), STOPS, PROFILES, VALENCES, WEIGHTS, "en")


def headline_etl(spark, sf):
    cleaned = _clean(spark, sf).select("id", "title_clean", "created_utc_iso", "polarity", "subjectivity")
    return rounded(cleaned, 8, "polarity", "subjectivity")


def headline_daily_sentiment(spark, sf):
    series = plans.daily_sentiment(plans.clean_rows(_clean(spark, sf)))
    return rounded(day_text(series, "created_utc_iso"), 6, "avg_sentiment", "normalized_avg")


QUERIES = {
    f.__name__: f
    for f in (
        notnull_filter, drop_any_null, nonempty_or_filter, year_range, date_parts, parse_dates, epoch_iso,
        union_files, shaped_columns, split_pair, clean_text, clean_turns, group_word_freq, words_top_2000,
        polarity_repeated,
        distinct_titles_joined, idf_table, pmi_table, polarity, polarity_join, polarity_large_join, polarity_label,
        subjectivity, subjectivity_join, language_profile, likely_language, english_only_filter,
        language_truth, gram_language, gram_language_truth, frequent_words_2000, headline_etl, headline_daily_sentiment,
    )
}

TOKENS = f"SELECT doc_id, lang, {tokens_sql('text')} AS words FROM documents"
_COMPOUND = "s / sqrt(s * s + 15::DOUBLE)"


def hits_sql(words: str, table: dict[str, float]) -> str:
    return f"""
        SELECT id, coalesce(sum(v), 0::DOUBLE) AS s, coalesce(avg(v), 0::DOUBLE) AS a
        FROM (SELECT id, unnest(CASE WHEN len(words) > 0 THEN words ELSE [''] END) AS word FROM ({words}))
        LEFT JOIN (VALUES {word_values(table)}) lex(word, v) USING (word) GROUP BY id
    """


_DOC_WORDS = f"SELECT doc_id AS id, words FROM ({TOKENS})"
_REPEATED = {w: (2 * v if v > 1 else v) for w, v in VALENCES.items()}
_POLARITY = f"""
    SELECT id AS doc_id, round({_COMPOUND}, 8) + 0.0 AS score FROM ({hits_sql(_DOC_WORDS, VALENCES)})
"""
_SUBJECTIVITY = f"SELECT id AS doc_id, round(a, 8) + 0.0 AS score FROM ({hits_sql(_DOC_WORDS, WEIGHTS)})"


def votes_sql(words: str) -> str:
    """Hits per id and language, and the place of the language among the id's."""
    per_lang = " UNION ALL ".join(
        f"SELECT id, '{lang}' AS lang, len(list_filter(words, lambda w: w IN ({quoted(ws)}))) AS hits FROM ({words})"
        for lang, ws in PROFILES.items()
    )
    return f"""
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY hits DESC, lang) AS place
        FROM ({per_lang}) WHERE hits > 0
    """


_VOTES = votes_sql(_DOC_WORDS)
_YEARLY = f"""
    SELECT DISTINCT CAST(year(day) AS INTEGER) AS year, array_to_string({kept_sql(tokens_sql('title'))}, ' ') AS t
    FROM ({HEADLINES})
"""

_WORD_RANKS = f"""
    WITH w AS (SELECT year, unnest(string_split(t, ' ')) AS word FROM ({_YEARLY})),
    c AS (SELECT year, word, count(*) AS n FROM w WHERE word <> '' AND word NOT IN ({quoted(words.PICTURE_STOP_WORDS)}) GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY n DESC, word) AS INTEGER) AS place FROM c)
"""

ETL = f"""
    WITH h AS MATERIALIZED (SELECT *, {tokens_sql('title')} AS words FROM ({HEADLINES})
          WHERE score IS NOT NULL AND title IS NOT NULL AND url IS NOT NULL AND domain IS NOT NULL AND created_utc IS NOT NULL),
    v AS ({votes_sql('SELECT id, words FROM h')}),
    k AS MATERIALIZED (SELECT h.id, created_utc, score, {kept_sql('words')} AS kept FROM h JOIN v ON h.id = v.id
          WHERE v.place = 1 AND v.lang = 'en' AND (url <> '' OR domain <> '')),
    c AS (SELECT k.id, array_to_string(kept, ' ') AS title_clean, score, make_timestamp(created_utc * 1000000) AS t,
                 p.s / sqrt(p.s * p.s + 15::DOUBLE) AS polarity, q.a AS subjectivity
          FROM k JOIN ({hits_sql('SELECT id, kept AS words FROM k', VALENCES)}) p ON k.id = p.id
                 JOIN ({hits_sql('SELECT id, kept AS words FROM k', WEIGHTS)}) q ON k.id = q.id
          WHERE array_to_string(kept, ' ') <> '')
"""

_GRAMS = rf"""
    WITH t AS (SELECT doc_id, lang, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4 = 0 AS held_back, words FROM ({TOKENS})),
    w AS (SELECT doc_id, lang, held_back, ' ' || w || ' ' AS w FROM (SELECT doc_id, lang, held_back, unnest(words) AS w FROM t) WHERE w <> ''),
    g AS MATERIALIZED (SELECT doc_id, lang, held_back, substr(w, i, 3) AS gram FROM (SELECT *, unnest(range(1, greatest(length(w) - 1, 2))) AS i FROM w)),
    n AS (SELECT gram, lang, count(*) AS n FROM g WHERE NOT held_back AND lang IS NOT NULL GROUP BY 1, 2),
    k AS (SELECT gram FROM n GROUP BY 1 HAVING sum(n) >= 3),
    s AS (SELECT lang, sum(n) + (SELECT count(*) FROM k) AS size FROM n GROUP BY 1),
    p AS MATERIALIZED (SELECT k.gram, s.lang, CAST(round(ln((coalesce(n.n, 0) + 1)::DOUBLE / s.size) * {language.UNIT}) AS BIGINT) AS weight
          FROM k CROSS JOIN s LEFT JOIN n ON n.gram = k.gram AND n.lang = s.lang),
    c AS (SELECT doc_id, gram, count(*) AS times FROM g WHERE held_back GROUP BY 1, 2),
    v AS (SELECT doc_id, p.lang, sum(weight * times) AS score FROM c JOIN p USING (gram) GROUP BY 1, 2),
    f AS (SELECT doc_id, arg_min(lang, (-score, lang)) AS found FROM v GROUP BY 1),
    j AS (SELECT t.doc_id, t.lang, coalesce(f.found, 'none') AS found FROM t LEFT JOIN f USING (doc_id) WHERE held_back)
"""

SQL = {
    "gram_language": f"{_GRAMS} SELECT doc_id, found FROM j",
    "gram_language_truth": f"{_GRAMS} SELECT lang, found, count(*) AS n FROM j GROUP BY 1, 2",
    "frequent_words_2000": f"{_WORD_RANKS} SELECT year, word, n, place FROM r WHERE place <= 2000",
    "notnull_filter": "SELECT doc_id, text, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL AND text IS NOT NULL",
    "drop_any_null": "SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL AND text IS NOT NULL",
    "nonempty_or_filter": f"""
        SELECT * FROM (SELECT doc_id, array_to_string({kept_sql(tokens_sql('text'))}, ' ') AS title_clean, source, lang FROM documents)
        WHERE title_clean <> '' AND (source <> '' OR lang <> '')
    """.replace("SELECT * FROM (", "SELECT doc_id, title_clean FROM (", 1),
    "year_range": f"SELECT id, CAST(year(day) AS INTEGER) AS year FROM ({HEADLINES}) WHERE year(day) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}",
    "date_parts": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_year FROM orders
    """,
    "parse_dates": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS raw, strftime(o_orderdate, '%Y/%m/%d') AS day FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus, 'unreadable' FROM orders
    """,
    "epoch_iso": f"SELECT id, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%dT%H:%M:%S') AS iso FROM ({HEADLINES})",
    "union_files": "SELECT doc_id AS id, text FROM documents UNION ALL SELECT conv_id, text FROM conversations UNION ALL SELECT item_id, text FROM benchmark",
    "shaped_columns": f"""
        SELECT id AS headline_id, score, num_comments, score + num_comments AS attention, 0::DOUBLE AS label FROM ({HEADLINES})
    """,
    "split_pair": "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[2] AS DOUBLE) AS second FROM embeddings",
    "clean_text": f"SELECT doc_id, array_to_string({kept_sql(tokens_sql('text'))}, ' ') AS title_clean FROM documents",
    "clean_turns": f"SELECT conv_id, turn, array_to_string({tokens_sql('text')}, ' ') AS clean FROM conversations",
    "group_word_freq": f"{_WORD_RANKS} SELECT year, word, n, place FROM r WHERE place <= {TOP_WORDS}",
    "words_top_2000": f"{_WORD_RANKS} SELECT year, word, n, place FROM r WHERE place <= 2000",
    "polarity_repeated": f"""
        SELECT id AS doc_id, round({_COMPOUND}, 8) + 0.0 AS joined, round({_COMPOUND}, 8) + 0.0 AS inline
        FROM ({hits_sql(_DOC_WORDS, _REPEATED)})
    """,
    "distinct_titles_joined": f"""
        WITH t AS ({_YEARLY}),
        s AS (SELECT year, t, ceil(count(*) OVER (PARTITION BY year) / {CHUNK}::DOUBLE)::BIGINT AS chunks FROM t)
        SELECT year, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % chunks AS chunk, string_agg(t, ' ' ORDER BY t) AS joined
        FROM s GROUP BY 1, 2
    """,
    "idf_table": f"""
        WITH w AS (SELECT DISTINCT doc_id, unnest(words) AS word FROM ({TOKENS})),
        f AS (SELECT word, count(*) AS doc_freq FROM w GROUP BY 1)
        SELECT word, doc_freq,
               CASE WHEN doc_freq >= 5 THEN round(ln(((SELECT count(*) FROM documents) + 1) / (doc_freq + 1)::DOUBLE), 8) + 0.0 ELSE 0::DOUBLE END AS idf
        FROM f
    """,
    "pmi_table": f"""
        WITH t AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM ({TOKENS})),
        k AS (SELECT w FROM t GROUP BY 1 HAVING count(*) >= 20),
        n AS (SELECT w, lead(w, 1) OVER o AS one, lead(w, 2) OVER o AS two FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        p AS (SELECT w AS a, one AS b FROM n UNION ALL SELECT w, two FROM n),
        d AS (SELECT a AS word, b AS context FROM p UNION ALL SELECT b, a FROM p),
        c AS MATERIALIZED (SELECT word, context, count(*) AS n FROM d WHERE word IN (FROM k) AND context IN (FROM k) GROUP BY 1, 2),
        s AS (SELECT word, CAST(sum(n) AS DOUBLE) AS n FROM c GROUP BY 1),
        q AS (SELECT c.word, c.context, c.n * (SELECT CAST(sum(n) AS DOUBLE) FROM c) AS together, s.n * z.n AS chance
              FROM c JOIN s ON c.word = s.word JOIN s z ON c.context = z.word)
        SELECT word, context, round(ln(together / chance), 6) + 0.0 AS value FROM q WHERE together > chance
    """,
    "polarity": _POLARITY,
    "polarity_join": _POLARITY,
    "polarity_large_join": _POLARITY,
    "polarity_label": f"""
        SELECT id AS doc_id, CASE WHEN {_COMPOUND} > 0.05::DOUBLE THEN 2::DOUBLE WHEN {_COMPOUND} < -0.05::DOUBLE THEN 0::DOUBLE ELSE 1::DOUBLE END AS label
        FROM ({hits_sql(_DOC_WORDS, VALENCES)})
    """,
    "subjectivity": _SUBJECTIVITY,
    "subjectivity_join": _SUBJECTIVITY,
    "language_profile": f"SELECT id AS doc_id, lang, hits FROM ({_VOTES}) WHERE place = 1",
    "likely_language": f"""
        SELECT d.doc_id, coalesce(v.lang, 'none') AS lang FROM documents d LEFT JOIN (SELECT * FROM ({_VOTES}) WHERE place = 1) v ON d.doc_id = v.id
    """,
    "english_only_filter": f"SELECT id AS doc_id FROM ({_VOTES}) WHERE place = 1 AND lang = 'en'",
    "language_truth": f"""
        SELECT d.lang, coalesce(v.lang, 'none') AS found, count(*) AS n
        FROM documents d LEFT JOIN (SELECT * FROM ({_VOTES}) WHERE place = 1) v ON d.doc_id = v.id GROUP BY 1, 2
    """,
    "headline_etl": f"""{ETL}
        SELECT id, title_clean, strftime(t, '%Y-%m-%dT%H:%M:%S') AS created_utc_iso, round(polarity, 8) + 0.0 AS polarity,
               round(subjectivity, 8) + 0.0 AS subjectivity FROM c
    """,
    "headline_daily_sentiment": f"""{ETL},
        r AS (SELECT CAST(t AS DATE) AS day, polarity, dense_rank() OVER (PARTITION BY CAST(t AS DATE) ORDER BY score DESC) AS place FROM c),
        d AS (SELECT day, avg(polarity) AS a FROM r WHERE place <= 100 GROUP BY day)
        SELECT strftime(day, '%Y-%m-%d') AS created_utc_iso, round(a, 6) + 0.0 AS avg_sentiment,
               round((a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()), 6) + 0.0 AS normalized_avg FROM d
    """,
}
