"""Price features next to a daily sentiment series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.relation import join_by_date
from tidemark.operators.series import DECOMPOSE_PERIOD, decomposed_features, standardized_daily

RELATED = ["difference", "standardized_residual", "standardized_sentiment_all_news"]


def price_and_sentiment(
    bars: DataFrame,
    sentiment: DataFrame,
    key: str = "Company",
    day: str = "Date",
    price: str = "Open",
    sentiment_col: str = "avg_sentiment_all_news",
    period: int = DECOMPOSE_PERIOD,
) -> DataFrame:
    """Decomposed price features joined by date with the standardised sentiment.

    The sentiment is standardised over all its days, before the join.
    """
    features = decomposed_features(bars, key, day, price, period)
    scaled = standardized_daily(sentiment, day, sentiment_col, "standardized_sentiment_all_news")
    return join_by_date(features, scaled, day)
