"""Null, repeated and very large ids, equal rows, clashing names, empty tables: through operators and the whole pipeline."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, near, spans, toxicity, warc, winnow
from tidemark.llm.common import repeated, table, unused
from tidemark.session import staged

SF = "/root/testdata/sf0.001"
BIG = 2**53 + 1
CLASHING = ("_id", "_hash", "_source", "_copies", "_rows", "row", "copies", "n", "other", "part", "turn", "place", "gone", "of_id", "OF_HASH", "rank", "size", "label", "score", "group", "dealt")


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))


def wide(df):
    """With columns named like those that operators use themselves."""
    return df.withColumns({c: F.length("text").cast("string") for c in CLASHING})


# Mixing


@pytest.fixture(scope="module")
def big_ids(spark):
    rows = [(BIG + k, words(k, 20 + k % 30), f"s{k % 3}") for k in range(240)] + [(None, words(999, 30), "s1")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_mixing_keeps_ids_beyond_doubles_beside_a_null(big_ids):
    found = mixing.mix(big_ids).collect()
    assert Counter(r["doc_id"] for r in found) == Counter([BIG + k for k in range(240)] + [None])
    for source in ("s0", "s1", "s2"):
        rows = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 50


def test_mixed_rows_are_those_the_mix_takes(big_ids):
    wanted = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(big_ids).collect() if r["copies"]})
    got = mixing.mixed(wide(big_ids))
    assert got.columns == wide(big_ids).columns
    assert Counter(r["doc_id"] for r in got.collect()) == wanted and len(wanted) > 100


def test_equal_rows_share_their_copies(spark):
    rows = [(5, "a b c d", "s0")] * 301 + [(None, "a b", "s0")] * 40 + [(k, words(k, 9), "s1") for k in range(100, 160)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    of_five = Counter(r["copies"] for r in found if r["doc_id"] == 5)
    assert sum(of_five.values()) == 301 and max(of_five) - min(of_five) <= 1 and max(of_five) <= 2
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    for source in ("s0", "s1"):
        same = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in same) - same[0]["target"]) <= 9
    wanted = Counter()
    for r in found:
        wanted[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixing.mixed(df).collect()) == +wanted


def test_equal_ids_and_texts_with_other_columns_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b c", "s", k % 4) for k in range(40)], "doc_id int, text string, source string, extra int")
    got = Counter(r["extra"] for r in mixing.mixed(df).collect())
    assert set(got) == {0, 1, 2, 3} and abs(sum(got.values()) - 60) <= 1 and max(got.values()) - min(got.values()) <= 1


def test_rows_are_repeated_in_bounded_arrays(spark):
    df = spark.createDataFrame([("a", 0), ("b", 7), ("c", 25), ("d", 1)], "k string, times bigint")
    assert Counter(r["k"] for r in repeated(df, "times", most=10).collect()) == {"b": 7, "c": 25, "d": 1}
    assert unused(["Part", "_part", "x"], "part", "turn", "X") == ["__part", "turn", "_X"]


# Toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    docs = [(k, words(k, 30) + (" vile scum " * 6 if k % 4 == 0 else " kind friend " * 6)) for k in range(200)]
    labels = [(k, int(k % 4 == 0)) for k in range(200)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_labels_of_absent_documents_count_for_nothing(spark, labelled, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 20)
    docs, labels = labelled
    absent = spark.range(10_000, 40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    one, other = (toxicity.fit(docs, x) for x in (labels, labels.union(absent)))
    assert one.learnt and (one.docs == other.docs).all() and one.docs.tolist() == [20, 20]
    assert (one.rate, one.shift, one.fit) == (other.rate, other.shift, other.fit)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, other).collect()}
    assert np.mean([scores[k] for k in range(0, 200, 4)]) > 0.8 > 0.2 > np.mean([scores[k] for k in range(1, 200, 4)])


def test_equal_rows_are_learnt_from_once(spark, labelled):
    docs, labels = labelled
    one, other = toxicity.fit(docs, labels), toxicity.fit(docs.union(docs.where("doc_id = 4")).union(docs.where("doc_id = 4")), labels)
    assert (one.docs == other.docs).all() and (one.words == other.words).all()


def test_it_warns_where_nothing_is_learnt(labelled):
    docs, labels = labelled
    with pytest.warns(UserWarning, match="nothing is learnt"):
        model = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}


# Archives


def test_archives_are_read_by_many_tasks(spark):
    """Under adaptive execution, for one bundle of many frames."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.col("id").cast("string"), F.lit(60)).alias("html")).coalesce(1)
    index = warc.write_bundles(pages, warc.archive_folder(spark), frame_bytes=2000)
    assert index.select("bundle").distinct().count() == 1
    read = warc.read_bundles(index, split_frames=3)
    assert read.rdd.getNumPartitions() == 8
    spread = [n for n in read.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(spread) == 8 and sum(spread) == 400
    got = {r["page_id"]: r["payload_digest"] for r in read.collect()}
    assert got == {k: warc.digest_of(str(k).encode() * 60) for k in range(400)}


# Near duplicates


def test_one_row_of_equal_copies_stays(spark):
    same, other = words(1, 40), words(2, 40)
    near_same = same + " end"
    rows = [(7, same), (7, same), (7, near_same), (9, same), (None, other), (None, other), (None, other + " end"), (3, words(3, 40)), (4, ""), (4, ""), (None, None)]
    df = wide(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = near.without_near_duplicates(df)
    assert got.columns == df.columns
    kept = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert kept[3, words(3, 40)] == 1 and kept[4, ""] == 2 and kept[None, None] == 1
    assert sum(n for (d, _), n in kept.items() if d in (7, 9)) == 1 and (9, same) not in kept
    assert sum(n for (d, t), n in kept.items() if d is None and t) == 1 and sum(kept.values()) == 6


def test_equal_rows_of_other_columns_leave_the_least(spark):
    df = spark.createDataFrame([(1, words(5, 30), k) for k in (4, 2, 9)] + [(2, words(6, 30), 1)], "doc_id int, text string, extra int")
    assert sorted((r["doc_id"], r["extra"]) for r in near.without_near_duplicates(df).collect()) == [(1, 2), (2, 1)]


# Sentence spans

PASSAGE = "This passage of a good many words is found in more than one document of the table. It goes on for a second sentence that also has some words."


def test_rows_without_an_id_are_told_apart(spark):
    rows = [(None, f"{words(k, 12)}. {PASSAGE} {words(50 + k, 12)}.") for k in range(3)] + [(5, f"Some words before it. {PASSAGE}")]
    df = wide(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = spans.remove_repeats(df).collect()
    holding = [r["doc_id"] for r in got if "goes on for a second" in r["text"]]
    assert holding == [5]
    alone = spans.remove_repeats(df.where("doc_id is null")).collect()
    assert sum("goes on for a second" in r["text"] for r in alone) == 1


def test_rows_that_share_an_id_are_told_apart(spark):
    rows = [(1, f"{words(k, 12)}. {PASSAGE} {words(50 + k, 12)}.") for k in range(4)] + [(8, f"{words(9, 12)}. {PASSAGE}")]
    got = spans.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [r["doc_id"] for r in got if "goes on for a second" in r["text"]] == [8]  # repeated ids come last
    equal = spans.remove_repeats(spark.createDataFrame([(1, rows[0][1])] * 3, "doc_id bigint, text string")).collect()
    assert {r["text"] for r in equal} == {rows[0][1]}


def test_ids_may_be_text(spark):
    rows = [(name, f"{words(k, 12)}. {PASSAGE}") for k, name in enumerate("abc")]
    got = spans.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sum("goes on for a second" in r["text"] for r in got) == 1 and {r["doc_id"] for r in got} == set("abc")


# Winnowing


def test_one_id_of_most_rows_is_in_several_ranges(spark):
    rows = [(77, f"text number {k} of one id") for k in range(3000)] + [(None, f"no id {k}") for k in range(2000)]
    rows += [(k, f"other {k}") for k in range(500, 700)] + [(2**62 + k, f"large {k}") for k in range(50)] + [(6, "the same")] * 400
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    placed = winnow.neighbours(df).where("not guest").withColumn("task", F.spark_partition_id())
    for where in ("doc_id = 77", "doc_id is null"):
        sizes = [r["count"] for r in placed.where(where).groupBy("part").count().collect()]
        assert len(sizes) > 5 and max(sizes) < 0.4 * sum(sizes)
    ordered = sorted(
        ((d, t, h) for d, t, h in df.select("doc_id", "text", F.xxhash64("text")).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]), reverse=True
    )
    wanted = Counter()
    for k, (d, t, _) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        wanted[d, hashlib.sha256(winnow.edited(t, following).encode()).hexdigest()] += 1
    got = Counter((r["doc_id"], r["edited_sha256"]) for r in winnow.compare_edited(df).collect())
    assert got == wanted


def test_ids_of_other_kinds_raise(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        winnow.compare_edited(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


# The pipeline

LONG = "word " * 30_000


@pytest.fixture(scope="module")
def odd_documents(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SF, "documents").collect()]
    rows += [(None, rows[0][1], None), (None, None, "x"), (3, "", None), (3, "", None), (BIG, LONG, "x"), (BIG, LONG, "x"), (4, " \n ", "y"), (None, words(4, 60), "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("bigint").alias("n_chars"))


def stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return out


@pytest.mark.filterwarnings("ignore:nothing is learnt")
def test_the_pipeline_takes_odd_rows(spark, odd_documents):
    found = {name: (before, after) for name, before, after in stages(spark, odd_documents)}
    for name in ("toxicity", "near_duplicates", "substring_duplicates", "mixing"):
        assert sorted(found[name][1].columns) == sorted(corpus_pipeline.COLUMNS)
    before, after = found["near_duplicates"]
    assert after.where(F.col("doc_id") == BIG).count() == 1 and after.where("doc_id = 3 and text = ''").count() == 2
    before, after = found["substring_duplicates"]
    assert before.count() == after.count()
    before, after = found["mixing"]
    assert after.where(F.col("doc_id") == BIG).count() in (1, 2)
    before, after = found["packing"]
    assert after.where("start = 0").count() == before.count()


@pytest.mark.filterwarnings("ignore:nothing is learnt")
def test_the_pipeline_takes_an_empty_table(spark, odd_documents):
    for _, _, after in stages(spark, odd_documents.where("false")):
        assert after.isEmpty()


@pytest.mark.filterwarnings("ignore:nothing is learnt")
@pytest.mark.parametrize("stage", ["toxic", "near", "mixed", "spans"])
def test_clashing_names_stay(spark, odd_documents, stage):
    run = {
        "toxic": lambda d: toxicity.without_toxic(d, table(spark, SF, "labels")),
        "near": near.without_near_duplicates,
        "mixed": mixing.mixed,
        "spans": lambda d: spans.remove_repeats(d).drop("n_sentences", "n_removed"),
    }[stage]
    df = wide(odd_documents)
    got, plain = run(df), run(odd_documents)
    assert got.columns == df.columns and got.count() == plain.count()
    assert run(df.where("false")).collect() == []
    rows = got.where("_id is not null and text is not null").select("_id", F.length("text").alias("n"))
    assert stage == "spans" or rows.where("cast(_id as int) <> n").isEmpty()
