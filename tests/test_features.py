"""One file from many tasks, files that don't agree, frequent words from summaries, languages by grams, bounded streams."""

import gzip
import json
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import frequent, language, words
from tidemark.sources import files, onefile, prices
from tidemark.streaming import bounded

# One file


@pytest.mark.parametrize("compressed", [False, True])
def test_one_file_is_in_order(spark, tmp_path, compressed):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.concat(F.lit('a, "b" '), "id").alias("text"), F.lit(None).cast("int").alias("none")).repartition(7)
    path = tmp_path / "out.csv"
    for _ in range(2):  # the second replaces the first
        onefile.write_one_file(df, str(path), ["k"], compressed)
    raw = path.read_bytes()
    lines = (gzip.decompress(raw) if compressed else raw).decode().splitlines()
    assert lines[0] == "k,text,none" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(5000))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out.csv"]
    if not compressed:
        got = spark.read.option("header", True).csv(str(path))
        assert got.where("text like 'a, \"b\" %'").count() == 5000
    parts = onefile.gzip.decompress(raw[: raw.index(b"\x1f\x8b", 10)]) if compressed else b"k,text,none\n"
    assert parts == b"k,text,none\n"


def test_one_file_of_no_rows_has_its_header(spark, tmp_path):
    onefile.write_one_file(spark.range(0), str(tmp_path / "none.csv"), ["id"])
    assert (tmp_path / "none.csv").read_text() == "id\n"
    onefile.write_one_file(spark.range(3), f"file://{tmp_path}/bare.csv", ["id"], header=False)
    assert (tmp_path / "bare.csv").read_text() == "0\n1\n2\n"


def test_parts_are_copied_one_after_another_where_files_have_no_places(tmp_path):
    import pyarrow as pa

    for k, text in enumerate(("b\n", "c\n")):
        (tmp_path / f"part-{k}").write_text(text)
    batch = pa.RecordBatch.from_arrays([pa.array([f"{tmp_path}/part-0", f"{tmp_path}/part-1"])], names=["path"])
    [done] = onefile._appended(iter([batch]), f"{tmp_path}/whole", b"a\n")
    assert (tmp_path / "whole").read_text() == "a\nb\nc\n" and done.column("size").to_pylist() == [4]


def test_one_text_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    copied, parts = [], onefile._parts
    monkeypatch.setattr(onefile, "_parts", lambda *a: copied.extend(found := parts(*a)) or found)
    df = spark.range(500).select(F.concat("id", F.lit(",\né")).alias("value")).repartition(6)
    for _ in range(2):  # the second replaces the first
        onefile.write_one_text(df, str(tmp_path / "whole"), "[\n", "0\n]\n")
    lines = (tmp_path / "whole").read_text().split("\n")
    assert lines[0] == "[" and lines[-3:] == ["0", "]", ""] and lines[2:-3:2] == ["é"] * 500
    assert sorted(lines[1:-3:2]) == sorted(f"{k}," for k in range(500)) and len(copied) == 12
    onefile.write_one_text(df.limit(0), f"file://{tmp_path}/none", "[", "]")
    assert (tmp_path / "none").read_text() == "[]"


# Files that don't agree


def test_mixed_price_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Open,Volume,Company\n2020-01-02,1.5,10,A\nsoon,2,3,A\n2020-01-03,null,5,A\n2020-01-04,1,2,\n2020-01-05,7\n")
    (tmp_path / "b.csv").write_text('Company,Note,Volume,Date\r\nB,"x, ""y""",7.5,2020-02-01\r\n')
    with gzip.open(tmp_path / "c.csv.gz", "wt") as out:
        out.write("Date,Open,Volume,Company\n2020-03-01,9,1,C\n,1,1,C\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only-header.csv").write_text("Open,Date\n")
    assert {h: len(f) for h, f in prices.headers(spark, str(tmp_path)).items()} == {
        "Date,Open,Volume,Company": 2, "Company,Note,Volume,Date": 1, "Open,Date": 1,
    }
    bars, rejected = prices.read_mixed_prices(spark, str(tmp_path))
    assert sorted((r["Company"], str(r["Date"]), r["Open"], r["Volume"]) for r in bars.collect()) == [
        ("A", "2020-01-02", 1.5, 10.0), ("A", "2020-01-03", None, 5.0), ("B", "2020-02-01", None, 7.5), ("C", "2020-03-01", 9.0, 1.0),
    ]
    told = sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"]) for r in rejected.collect())
    assert told == [
        ("a.csv", "2020-01-04,1,2,", "no company"), ("a.csv", "2020-01-05,7", "fields are not those of the header"),
        ("a.csv", "soon,2,3,A", "no date"), ("c.csv.gz", ",1,1,C", "no date"),
    ]
    (tmp_path / "twice.csv").write_text("Date,Date\n")
    with pytest.raises(ValueError, match="twice"):
        prices.read_mixed_prices(spark, str(tmp_path / "twice.csv"))
    assert prices.read_mixed_prices(spark, str(tmp_path / "empty.csv")).bars.isEmpty()


# Frequent words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefghij"), max_size=12), max_size=30), st.integers(1, 4))
def test_summaries_bound_every_count(texts, capacity):
    summary, true = frequent.Summary(capacity), Counter()
    for words_ in texts:
        summary.add(words_)
        true.update(words_)
    summary.shrink()
    assert len(summary.counts) <= capacity
    for w in "abcdefghij":
        low = summary.counts.get(w, 0)
        assert low <= true[w] <= low + summary.error


@pytest.fixture(scope="module")
def titles(spark):
    rng = np.random.default_rng(7)
    rows = [(int(k % 3), " ".join(f"w{min(int(x), 3000)}" for x in rng.zipf(1.4, 30))) for k in range(900)]
    rows += [(3, "each word once only here"), (3, "tie tie"), (None, "no group"), (4, "new world"), (2, None), (5, "")]
    return spark.createDataFrame(rows, "g int, t string").repartition(5)


@pytest.mark.parametrize(("k", "capacity"), [(5, 40), (20, 400), (50, 10), (3000, 20_000)])
def test_frequent_words_are_those_of_the_full_count(titles, k, capacity):
    got = sorted(map(tuple, frequent.frequent_words(titles, "g", "t", k, capacity=capacity).select("g", "word", "n", "place").collect()))
    want = sorted(map(tuple, words.word_freq(titles, "g", "t", k).select("g", "word", "n", "place").collect()))
    assert got == want and len(want) > 10


def test_fewer_rows_are_shuffled(spark, monkeypatch):
    """Long tails of words that occur once stay in their tasks."""
    df = spark.range(4000).select(F.lit(1).alias("g"), F.concat_ws(" ", F.array_repeat(F.lit("often"), 3), F.concat(F.lit("also"), F.col("id") % 5), F.concat(F.lit("x"), "id"), F.concat(F.lit("y"), "id")).alias("t"))
    seen = {}
    plain = frequent.staged
    monkeypatch.setattr(frequent, "staged", lambda d, name: seen.setdefault(name, plain(d, name)))
    got = frequent.frequent_words(df, "g", "t", 5, capacity=50).orderBy("place").collect()
    assert [r["n"] for r in got] == [12000] + [800] * 4 and got[1]["word"] == "also0"
    every = words.word_counts(df, "g", "t").count()
    assert every > 8000 and seen["summaries"].count() < 0.1 * every and seen["asked"].count() <= 50


# Languages


def test_grams(spark):
    df = spark.createDataFrame([(["ab", "", None, "c"],), ([],), (None,)], "w array<string>")
    assert [r["g"] for r in df.select(language.ngrams(F.col("w")).alias("g")).collect()] == [[" ab", "ab ", " c "], [], None]
    assert df.select(language.ngrams(F.col("w"), 9).alias("g")).head()["g"] == [" ab ", " c "]


def test_likeliest_language_is_that_of_plain_python(spark, monkeypatch):
    docs = [("en", "the cat and the hat"), ("de", "die katze und der hut"), ("en", "that other thing then"), ("de", "der andere und dann die"), (None, "zzz")]
    df = spark.createDataFrame([(k, x, t.split(" ")) for k, (x, t) in enumerate(docs)], "id int, lang string, w array<string>")
    langs, profiles = language.learn(df, "w", "lang", min_count=2)
    grams = lambda t: [f" {w} "[i : i + 3] for w in t.split(" ") for i in range(len(w))]
    counts = {x: Counter(g for y, t in docs if y == x for g in grams(t)) for x in ("de", "en")}
    kept = [g for g in set(counts["de"]) | set(counts["en"]) if counts["de"][g] + counts["en"][g] >= 2]
    weight = {g: [round(float(np.log((counts[x][g] + 1) / (counts[x].total() + len(kept)))) * 1000) for x in ("de", "en")] for g in kept}
    assert langs == ["de", "en"] and {r["gram"]: r["weights"] for r in profiles.collect()} == weight
    asked = ["the hat", "und der katze", "", "qqq", "dann then"]
    frame = spark.createDataFrame([(k, t.split(" ")) for k, t in enumerate(asked)], "id int, w array<string>")
    want = {}
    for k, t in enumerate(asked):
        known = [weight[g] for g in grams(t) if g in weight]
        if known:
            sums = np.sum(known, axis=0)
            want[k] = langs[int(np.argmax(sums))]
    for bound in (language.BROADCAST_ROWS, 0):
        monkeypatch.setattr(language, "BROADCAST_ROWS", bound)
        assert {r["id"]: r["lang"] for r in language.most_likely(frame, "id", "w", langs, profiles).collect()} == want
    assert want[0] == "en" and want[1] == "de" and 3 not in want


def test_grams_judge_more_documents_rightly_than_stop_words(spark):
    from checks import texts

    rows = {name: texts.QUERIES[name](spark, "/root/testdata/sf0.01").collect() for name in ("language_truth", "gram_language_truth")}
    share = {name: sum(r["n"] for r in found if r["lang"] == r["found"]) / sum(r["n"] for r in found) for name, found in rows.items()}
    print(share)
    assert share["gram_language_truth"] > 0.95 and share["gram_language_truth"] >= share["language_truth"]


# Bounded streams


def dropped(folder, count):
    folder.mkdir(exist_ok=True)
    for k in range(count):
        (folder / f"{k}.json").write_text(json.dumps([{"id": 10 * k + j} for j in range(3)]))


def test_a_bounded_run_goes_on_where_it_stopped(spark, tmp_path):
    dropped(tmp_path / "in", 9)
    wanted = sorted(10 * k + j for k in range(9) for j in range(3))
    schema = spark.createDataFrame([], "id bigint").schema

    def start(**more):
        return bounded.write_batches(files.stream_headlines(spark, str(tmp_path / "in"), schema, max_files=1), str(tmp_path / "out"), str(tmp_path / "c"), **more)

    query = start()
    last = bounded.run_for(query, 60, batches=2)
    assert not query.isActive and last >= 1
    some = [r["id"] for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()]
    assert len(some) == len(set(some)) and 6 <= len(some) < 27
    query = start()
    bounded.run_for(query, 0.0)
    assert not query.isActive
    # A batch whose commit is lost is run again and replaces its rows.
    newest = max((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    newest.unlink()
    (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)
    bounded.run_for(start(available_now=True), 120)
    assert sorted(r["id"] for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()) == wanted


def test_a_failed_run_raises(spark, tmp_path):
    dropped(tmp_path / "in", 1)
    rows = files.stream_headlines(spark, str(tmp_path / "in"), spark.createDataFrame([], "id bigint").schema)
    query = bounded.write_batches(rows.select(F.raise_error(F.lit("it broke"))), str(tmp_path / "out"), str(tmp_path / "c"))
    with pytest.raises(Exception, match="it broke"):
        bounded.run_for(query, 60)
