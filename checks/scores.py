"""Top scores per day, means, scaling, paging."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.tables import DAY_EVENTS, day_events, day_text, rounded, table
from tidemark.operators import fits, paging, scaling, topk
from tidemark.plans import headlines
from tidemark.session import new_folder

PAGE_AFTER = ("2024-01-11 00:00:00", 0)
PAGE_SIZE = 500


def daily_top_scaled(spark, sf):
    series = headlines.daily_sentiment(day_events(spark, sf), "day", "score")
    return rounded(day_text(series, "day"), 6, "avg_sentiment", "normalized_avg")


def daily_top_scaled_rows(spark, sf):
    series = headlines.daily_sentiment_from_rows(day_events(spark, sf), "day", "score")
    return rounded(day_text(series, "day"), 6, "avg_sentiment", "normalized_avg")


def daily_news_series(spark, sf):
    """Mean over all rows and over the best-scored rows of a day, each under its own name."""
    both = headlines.daily_series_of_news(day_events(spark, sf), "day")
    return rounded(day_text(both, "day"), 6, headlines.ALL_NEWS, headlines.TOP_NEWS)


def top_rows_by_day(spark, sf):
    kept = topk.keep_top_distinct(day_events(spark, sf), "day", "score")
    return day_text(kept, "day").select("day", "event_id", "score")


def topk_join_form(spark, sf):
    kept = topk.keep_top_listed(day_events(spark, sf), "day", "score")
    return day_text(kept, "day").select("day", "event_id", "score")


def top_scores_by_day(spark, sf):
    lists = topk.top_scores(day_events(spark, sf), "day", "score")
    cents = F.transform("scores", lambda s: F.round(s * 100).cast("bigint").cast("string"))
    return day_text(lists, "day").select("day", F.array_join(cents, " ").alias("scores"))


def distinct_scores(spark, sf):
    return day_text(topk.distinct_scores(day_events(spark, sf), "day", "score"), "day")


def group_mean_daily(spark, sf):
    means = scaling.group_mean(day_events(spark, sf), "day", "polarity", "avg_polarity")
    return rounded(day_text(means, "day"), 8, "avg_polarity")


def min_max_values(spark, sf):
    scaled = scaling.min_max(day_events(spark, sf), "score", "scaled")
    return rounded(scaled.select("event_id", "scaled"), 6, "scaled")


def min_max_by_type(spark, sf):
    scaled = scaling.min_max(day_events(spark, sf), "score", "scaled", by="event_type")
    return rounded(scaled.select("event_id", "event_type", "scaled"), 6, "scaled")


def z_score_values(spark, sf):
    scaled = scaling.z_score(day_events(spark, sf), "score", "z")
    return rounded(scaled.select("event_id", "z"), 6, "z")


def z_score_by_day(spark, sf):
    scaled = scaling.z_score(day_events(spark, sf), "score", "z", by="day")
    return rounded(scaled.select("event_id", "z"), 6, "z")


def merged_z_score(spark, sf):
    """Per-day fits of two halves of the events, merged and applied to all of them."""
    rows = day_events(spark, sf)
    halves = [fits.fit_states(rows.where(F.col("event_id") % 2 == half), "score", ["day"]) for half in (0, 1)]
    merged = fits.merge_states(halves[0].unionByName(halves[1]), ["day"])
    return rounded(fits.scale_by_key(rows, "score", "z", merged, "day").select("event_id", "z"), 6, "z")


def stored_min_max(spark, sf):
    """Fits stored per day while a fifth of the last days' events is missing; then these days alone are fitted anew."""
    path, rows = new_folder(spark, "fits"), day_events(spark, sf)
    last = rows.agg(F.max("day")).head()[0]
    changed = [last - timedelta(days=k) for k in range(3)]
    fits.store_states(rows.where(~F.col("day").isin(changed) | (F.col("event_id") % 5 > 0)), "score", "day", path)
    fits.store_states(rows, "score", "day", path, changed)
    state = fits.merge_states(fits.load_states(spark, path)).head()
    return rounded(fits.scale_with(rows, "score", "scaled", state).select("event_id", "scaled"), 6, "scaled")


def keyset_page(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_id", "value")
    page = paging.keyset_page(events, ["ts", "event_id"], PAGE_AFTER, PAGE_SIZE)
    return page.select("event_id", "value")


def numbered_pages(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_id")
    return paging.number_pages(events, ["ts", "event_id"], PAGE_SIZE).select("event_id", "page", "place")


def page_documents(spark, sf):
    events = table(spark, sf, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id")
    pages = paging.page_documents(events, ["us", "event_id"], PAGE_SIZE)
    return pages.select("page", F.coalesce("after", F.lit(0)).alias("after"), "rows", "body")


QUERIES = {
    f.__name__: f
    for f in (
        daily_top_scaled, daily_top_scaled_rows, daily_news_series, top_rows_by_day, topk_join_form, top_scores_by_day,
        distinct_scores, group_mean_daily, min_max_values, min_max_by_type, z_score_values,
        z_score_by_day, merged_z_score, stored_min_max, keyset_page, numbered_pages, page_documents,
    )
}

_RANKED = f"""
    WITH e AS ({DAY_EVENTS}),
    r AS (SELECT *, dense_rank() OVER (PARTITION BY day ORDER BY score DESC) AS place FROM e)
"""
_DAILY = f"""{_RANKED},
    d AS (SELECT day, avg(polarity) AS a FROM r WHERE place <= 100 GROUP BY day)
    SELECT strftime(day, '%Y-%m-%d') AS day, round(a, 6) + 0.0 AS avg_sentiment,
           round(CASE WHEN max(a) OVER () = min(a) OVER () THEN 0.5
                 ELSE (a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) END, 6) + 0.0 AS normalized_avg
    FROM d
"""
_TOP_ROWS = f"{_RANKED} SELECT strftime(day, '%Y-%m-%d') AS day, event_id, score FROM r WHERE place <= 100"

_MIN_MAX = """
    SELECT event_id, round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()), 6) + 0.0 AS scaled
    FROM events
"""
_Z_BY_DAY = f"""
    SELECT event_id, round((score - avg(score) OVER w) / stddev_pop(score) OVER w, 6) + 0.0 AS z
    FROM ({DAY_EVENTS}) WINDOW w AS (PARTITION BY day)
"""

SQL = {
    "daily_top_scaled": _DAILY,
    "daily_top_scaled_rows": _DAILY,
    "daily_news_series": f"""{_RANKED},
        d AS (SELECT day, avg(polarity) AS a, avg(polarity) FILTER (WHERE place <= 100) AS t FROM r GROUP BY day)
        SELECT strftime(day, '%Y-%m-%d') AS day,
               round((a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()), 6) + 0.0 AS avg_sentiment_all_news,
               round((t - min(t) OVER ()) / (max(t) OVER () - min(t) OVER ()), 6) + 0.0 AS avg_sentiment_top_news
        FROM d
    """,
    "top_rows_by_day": _TOP_ROWS,
    "topk_join_form": _TOP_ROWS,
    "top_scores_by_day": f"""{_RANKED},
        d AS (SELECT DISTINCT day, score FROM r WHERE place <= 100)
        SELECT strftime(day, '%Y-%m-%d') AS day,
               string_agg(CAST(CAST(round(score * 100) AS BIGINT) AS VARCHAR), ' ' ORDER BY score DESC) AS scores
        FROM d GROUP BY 1
    """,
    "distinct_scores": f"SELECT DISTINCT strftime(day, '%Y-%m-%d') AS day, score FROM ({DAY_EVENTS})",
    "group_mean_daily": f"""
        SELECT strftime(day, '%Y-%m-%d') AS day, round(avg(polarity), 8) + 0.0 AS avg_polarity
        FROM ({DAY_EVENTS}) GROUP BY 1
    """,
    "min_max_values": _MIN_MAX,
    "stored_min_max": _MIN_MAX,
    "min_max_by_type": """
        SELECT event_id, event_type,
               round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w), 6) + 0.0 AS scaled
        FROM events WINDOW w AS (PARTITION BY event_type)
    """,
    "z_score_values": """
        SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) + 0.0 AS z FROM events
    """,
    "z_score_by_day": _Z_BY_DAY,
    "merged_z_score": _Z_BY_DAY,
    "keyset_page": f"""
        SELECT event_id, value FROM events
        WHERE (ts, event_id) > (TIMESTAMP '{PAGE_AFTER[0]}', {PAGE_AFTER[1]})
        ORDER BY ts, event_id LIMIT {PAGE_SIZE}
    """,
    "numbered_pages": f"""
        SELECT event_id, CAST((row_number() OVER o - 1) // {PAGE_SIZE} AS BIGINT) AS page,
               CAST((row_number() OVER o - 1) % {PAGE_SIZE} AS BIGINT) AS place
        FROM events WINDOW o AS (ORDER BY ts, event_id)
    """,
    "page_documents": f"""
        WITH e AS (SELECT epoch_us(ts) AS us, event_id,
                          (row_number() OVER (ORDER BY ts, event_id) - 1) // {PAGE_SIZE} AS page FROM events),
        p AS (SELECT page, count(*) AS n, max(us) AS last_us,
                     '[' || string_agg('{{"us":' || us || ',"event_id":' || event_id || '}}', ',' ORDER BY us, event_id) || ']' AS body
              FROM e GROUP BY page)
        SELECT CAST(page AS BIGINT) AS page, coalesce(lag(last_us) OVER (ORDER BY page), 0) AS after,
               CAST(n AS BIGINT) AS rows, body FROM p
    """,
}
