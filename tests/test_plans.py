"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from checks import catalog
from checks.tables import STOPS, VALENCES, WEIGHTS, day_events, headlines, orders
from tidemark.operators import paging, rows, series, topk
from tidemark.streaming.headlines import prepare

SF = "/root/testdata/sf0.001"
# These start streams or fit models while they are built.
EAGER = {
    "stream_prepare", "stream_lexicon_join", "stream_page_files", "stream_score", "train_predict", "train_metrics", "cursor_feed", "train_other",
    "stream_score_differences", "validation_labels", "assembled_numbers", "loaded_model_agrees", "slot_idf", "page_array_scan",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in EAGER])
def test_no_python_rows_and_no_products(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_top_scores_are_cut_before_the_shuffle(spark):
    text = plan(topk.top_distinct_mean(day_events(spark, SF), "day", "score", "polarity", "m"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_kept_rows_are_not_shuffled_by_day(spark):
    """The scan of the rows goes into a broadcast join; only pairs of day and score move."""
    text = plan(topk.keep_top_distinct(day_events(spark, SF), "day", "score"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2


def test_one_shuffle_by_key_serves_all_windows_of_a_decomposition(spark):
    text = plan(series.decompose(orders(spark, SF), "o_orderpriority", "o_orderdate", "price"))
    assert text.count("Exchange hashpartitioning") == 2  # daily means, then the series of a key


def test_years_reach_the_scan(spark):
    days = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    kept = rows.years_between(days, "o_orderdate", 1996, 1997)
    assert "GreaterThanOrEqual(o_orderdate" in plan(kept)


def test_a_page_is_a_bounded_sort(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_id")
    text = plan(paging.keyset_page(events, ["ts", "event_id"], ("2024-01-05 00:00:00", 0), 10))
    assert "TakeOrderedAndProject" in text and "GreaterThanOrEqual(ts" in text


def test_cleaning_is_one_narrow_pass(spark):
    from checks.tables import PROFILES
    from tidemark.plans.headlines import clean_headlines

    raw = spark.createDataFrame(headlines(spark, SF).limit(5).toPandas().drop(columns="day"))
    text = plan(clean_headlines(raw, STOPS, PROFILES, VALENCES, WEIGHTS, "en"))
    assert "Exchange" not in text
    assert text.count("regexp_replace") == 1


def test_preparation_splits_the_text_once(spark):
    raw = headlines(spark, SF).select("title", "score", "num_comments")
    assert plan(prepare(raw, STOPS, WEIGHTS)).count("regexp_replace") == 1


def test_scans_read_only_needed_columns(spark):
    text = plan(topk.top_distinct_mean(day_events(spark, SF), "day", "score", "polarity", "m"))
    schemas = {line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line}
    assert schemas == {"struct<ts:timestamp_ntz,value:double,props:string>"}


def test_a_small_lexicon_costs_one_shuffle_of_hits(spark):
    from checks import texts

    for name in ("polarity_join", "subjectivity_join"):
        text = plan(texts.QUERIES[name](spark, SF))
        keys = [line.split("hashpartitioning(")[1].split(",")[0] for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert sum("doc_id" in k for k in keys) == 1 and all("doc_id" in k or "word" in k for k in keys)
        assert "SortMergeJoin" not in text and text.count("partial_sum(_value") == 1


def test_large_key_tables_are_not_broadcast_blindly(spark):
    """A key without a bound is staged, so that its size decides the join."""
    df = spark.range(1000).select((F.col("id") % 400).cast("string").alias("g"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(topk.keep_top_distinct(df, "g", "id", 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(topk.keep_top_distinct(df, "g", "id", 1))
