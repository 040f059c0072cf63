"""Column functions on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, scoring, text as tx
from tidemark.operators import rows

ENGLISH = ["the", "a", "of", "say"]


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).head()["r"]


@pytest.mark.parametrize(
    "given, tokens",
    [
        ("Good, BAD day", ["good", "bad", "day"]),
        ("The good   good_x", ["good", "", "", "goodx"]),
        ("foo  bar ", ["foo", "", "bar", ""]),
        ("Élan—vital ÑANDÚ 3½ 東京!", ["élanvital", "ñandú", "3½", "東京"]),
        ("tab\tand\nline stay", ["tab\tand\nline", "stay"]),
        ("say say it, Say!", ["it"]),
        ("", [""]),
        (None, None),
    ],
)
def test_tokens_without_stop_words(spark, given, tokens):
    assert one(spark, given, "string", lambda c: tx.without_words(tx.tokens(c), ENGLISH)) == tokens


def test_cleaning_agrees_with_the_unicode_classes_of_python(spark):
    """Over the letters, digits and marks of the common scripts."""
    import re

    points = [p for p in range(0x20, 0x530) if p != 0x378]
    df = spark.createDataFrame([(p, chr(p)) for p in points], "p int, c string")
    kept = {r["p"] for r in df.where(F.regexp_replace("c", tx.STRIPPED, "") != "").collect()}
    assert kept == {p for p in points if not re.fullmatch(r"[^\s\w]|_", chr(p))}


def test_default_stop_words(spark):
    words = tx.default_stop_words(["english"])
    assert "say" in words and "the" in words and "der" not in words
    assert "der" in tx.default_stop_words()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_epoch_does_not_depend_on_the_time_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, 1572591634, "bigint", dates.epoch_to_iso) == "2019-11-01T07:00:34"
        assert one(spark, 1552185000, "bigint", dates.epoch_to_iso) == "2019-03-10T02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates(spark):
    assert str(one(spark, "2019-11-02", "string", dates.parse_date)) == "2019-11-02"
    assert one(spark, "soon", "string", dates.parse_date) is None


@pytest.mark.parametrize("index, expected", [(0, [0.1, 0.1, None, None]), (1, [0.2, None, None, None])])
def test_pairs(spark, index, expected):
    df = spark.createDataFrame([([0.1, 0.2],), ([0.1],), ([],), (None,)], "p array<double>")
    split = rows.split_pair(df, "p", "first", "second").collect()
    assert [r[1 + index] for r in split] == expected


@pytest.mark.parametrize(
    "value, kind, label",
    [
        (0.05, "float", 2.0),
        (0.05, "double", 1.0),
        (0.0501, "double", 2.0),
        (-0.06, "double", 0.0),
        (-0.05, "double", 1.0),
        (0.0, "double", 1.0),
        (float("nan"), "double", 1.0),
        (None, "double", None),
    ],
)
def test_label(spark, value, kind, label):
    assert one(spark, value, kind, scoring.polarity_label) == label


def test_lexicon_scores(spark):
    words = spark.createDataFrame(
        [(["good", "bad", "day"],), (["good", "", "", "goodx"],), (["good", "good"],), ([],), (None,)],
        "w array<string>",
    )
    table = {"good": 1.9, "bad": -2.5}
    got = words.select(
        scoring.polarity(F.col("w"), table).alias("p"), scoring.subjectivity(F.col("w"), table).alias("s")
    ).collect()
    compound = [s / math.sqrt(s * s + 15) for s in (-0.6, 1.9, 3.8, 0.0)]
    assert [r["p"] for r in got[:4]] == pytest.approx(compound)
    assert got[0]["p"] == pytest.approx(-0.153093, abs=1e-6)
    assert [r["s"] for r in got[:4]] == pytest.approx([-0.3, 1.9, 1.9, 0.0])
    assert got[4]["p"] is None and got[4]["s"] is None


def test_large_lexicon(spark):
    """Sums agree with a plain dictionary for a table that is cut into many maps."""
    table = {f"wört{i}": i / 7 - 100 for i in range(3000)}
    docs = [[f"wört{(i * 37 + j * 11) % 4000}" for j in range(50)] for i in range(20)]
    df = spark.createDataFrame([(d,) for d in docs], "w array<string>")
    got = [r[0] for r in df.select(scoring.array_sum(scoring.known_values(F.col("w"), table))).collect()]
    assert got == pytest.approx([sum(table.get(w, 0) for w in d) for d in docs])


def test_language(spark):
    profiles = {"en": ["the", "of"], "de": ["der", "die"], "fr": ["de", "of"]}
    words = [["the", "of", "die"], ["der", "the"], ["of"], ["x"], [], None]
    df = spark.createDataFrame([(w,) for w in words], "w array<string>")
    got = [r[0] for r in df.select(scoring.likely_language(F.col("w"), profiles)).collect()]
    assert got == ["en", "de", "en", None, None, None]


def test_numbers(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(numbers.real(F.col("x"))).collect()] == [1.0, 0.0, -1.0, None, None]
    logs = [r[0] for r in df.limit(3).select(numbers.natural_log(F.col("x"))).collect()]
    assert logs == [0.0, None, None]


def test_require_filters(spark):
    df = spark.createDataFrame(
        [("a", "u", "d"), ("a", "", "d"), ("a", "", ""), ("", "u", "d"), (None, "u", "d"), ("a", None, "d")],
        "t string, u string, d string",
    )
    assert rows.require_non_null(df, ["t", "u"]).count() == 4
    assert rows.require_non_empty(df, "t", ["u", "d"]).count() == 3


def test_split_is_whole_and_repeatable(spark):
    df = spark.range(2000)
    training, validation = rows.split_rows(df, "id")
    assert training.count() + validation.count() == 2000
    assert 400 < validation.count() < 600
    again = rows.split_rows(df.repartition(7), "id")[1]
    assert validation.exceptAll(again).isEmpty()
