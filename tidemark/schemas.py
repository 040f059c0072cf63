"""Fixed row layouts, so that no job has to infer a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _layout(fields: str) -> T.StructType:
    schema = T.StructType()
    for field in fields.split(","):
        schema.add(*field.split())
    return schema


# Field names and types of a raw headline page.
RAW_HEADLINE = _layout(
    """
    allow_live_comments boolean, author string, author_flair_css_class string,
    author_flair_text string, author_flair_type string, author_fullname string,
    author_patreon_flair boolean, can_mod_post boolean, contest_mode boolean,
    created_utc long, domain string, full_link string, id string, is_crosspostable boolean,
    is_meta boolean, is_original_content boolean, is_reddit_media_domain boolean,
    is_robot_indexable boolean, is_self boolean, is_video boolean,
    link_flair_background_color string, link_flair_text_color string, link_flair_type string,
    locked boolean, media_only boolean, no_follow boolean, num_comments long,
    num_crossposts integer, og_description string, og_title string, over_18 boolean,
    parent_whitelist_status string, permalink string, pinned boolean, pwls integer,
    retrieved_on long, score long, selftext string, send_replies boolean, spoiler boolean,
    stickied boolean, subreddit string, subreddit_id string, subreddit_subscribers long,
    subreddit_type string, thumbnail string, title string, total_awards_received integer,
    url string, whitelist_status string, wls integer
    """
)

# Fields a raw headline must have to be used.
REQUIRED_RAW_FIELDS = ["score", "title", "url", "domain", "created_utc"]

# A cleaned headline. Files that hold [polarity, subjectivity] in one array have PAIRED_HEADLINE.
CLEAN_HEADLINE = _layout(
    "title_clean string, title string, created_utc_iso date, polarity double,"
    " subjectivity double, score long, num_comments long"
)
PAIRED_HEADLINE = (
    _layout("title_clean string, title string, created_utc_iso date")
    .add("polarity_subjectivity", T.ArrayType(T.FloatType()))
    .add("score", "long")
    .add("num_comments", "long")
)

# A headline as it arrives on the stream.
STREAM_HEADLINE = _layout("title string, score long, num_comments long")

# A daily price bar, a decomposed price series, and a daily sentiment series.
PRICE_BAR = _layout("Date date, Open double, Volume double, Company string")
DECOMPOSED = _layout(
    "Company string, Date date, trend double, seasonality double, residual double,"
    " difference double, standardized_residual double"
)
DAILY_SENTIMENT = _layout("Date date, avg_sentiment_all_news double")

# Word tables that stand for library lexicons.
LEXICON = _layout("word string, valence double, subjectivity double")
STOP_WORDS = _layout("lang string, word string")
