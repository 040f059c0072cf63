"""Queries of the operators against their SQL, and the edge cases that all operators share."""

import pytest

from checks import compare
from tidemark.llm import align, mixing, near, packing, queries, rules, sharding, simhash, spans, toxicity, urls, warc, winnow

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    result = compare.connect(SF).sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    got = compare._rows(df.columns, df.collect())
    assert got and got == compare._rows(result.columns, result.fetchall())


LONG = "word " * 60_000
# A null id, a null and an empty text, gaps alone, repeated rows, equal ids with other texts, a very long text, and
# columns named like those the operators add.
ROWS = [
    (1, "The cat sat on the mat. It was a fine mat indeed, and the cat was glad of it for hours.\nYes.", "a", 5),
    (1, "The cat sat on the mat. It was a fine mat indeed, and the cat was glad of it for hours.\nYes.", "a", 5),
    (1, "Another text under the same id.", "b", 1),
    (2, None, None, None),
    (3, "", "a", 0),
    (4, " \n\t ", "b", 4),
    (5, LONG, "b", len(LONG)),
    (None, "A row without an id, of some words.", "c", 3),
    (6, "Ünï   cödé 漢字 \U0001f600 <|endoftext|>  two  gaps ", None, 9),
]
SCHEMA = "doc_id bigint, text string, source string, n_chars bigint"
CLASHING = ("rank", "size", "label", "node", "score", "copies", "slot", "shard", "n_removed", "part", "_id", "_hash", "kept", "bits", "block")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: df["n_chars"].cast("string") for c in CLASHING})


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


LABELS = [(1, 0), (3, 1), (5, 0), (6, 1), (6, 0), (None, 1), (9, None)]


def operators(spark):
    labels = spark.createDataFrame(LABELS, "doc_id bigint, toxic int")
    return {
        "near": lambda d: near.near_duplicates(d, 3, 85),
        "mixing": mixing.mix,
        "packing": lambda d: packing.pack(d, *queries.tokenizer()),
        "rules": rules.ledger,
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "shards": lambda d: sharding.with_shard(d, ("x", "y", "z"), slots=101),
        "winnow": winnow.compare_edited,
        "fingerprints": winnow.fingerprints,
        "spans": spans.remove_repeats,
        "simhash": simhash.near_duplicates,
        "align": lambda d: align.align(d, *queries.tokenizer_files()),
    }


NAMES = ("near", "mixing", "packing", "rules", "toxicity", "shards", "winnow", "fingerprints", "spans", "simhash", "align")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_each_have_a_result(spark, odd, name):
    rows = operators(spark)[name](odd).collect()
    wanted = sorted(str(r[0]) for r in ROWS)
    if name == "packing":
        rows = [r for r in rows if r["start"] == 0]
    assert sorted(str(r["doc_id"]) for r in rows) == wanted


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_table_gives_no_rows(spark, none, name):
    assert operators(spark)[name](none).collect() == []


PAGES = [
    (1, "HTTP://WWW.Example.ORG/es/1?x#y", "<p>a</p>"),
    (2, "https://example.org", "<p>a</p>"),
    (3, "no scheme", "<p>a</p>"),
    (4, None, None),
    (5, "http://a.com/fr/", ""),
    (None, "http://a.com/de/\r\nX: y", "<p>b</p>"),
    (6, "http://a.net/x", "é" * 100_000),
    (6, "http://a.net/x", "é" * 100_000),
    (7, "://host#frag", "<p>b</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    return df.withColumns({c: df["url"] for c in ("host", "rule", "score", "digest", "offset", "bundle")})


def test_odd_urls(pages):
    rows = {(r["page_id"], r["url"]): r for r in urls.judge_urls(pages, queries.URL_RULES).collect()}
    assert len(rows) == 8
    first = rows[1, PAGES[0][1]]
    assert (first["host"], first["path"], first["rule"], first["verdict"]) == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert (rows[2, "https://example.org"]["path"], rows[2, "https://example.org"]["rule"]) == ("", None)
    assert rows[4, None]["host"] == rows[3, "no scheme"]["host"] == "" and rows[4, None]["verdict"] in ("allow", "block")
    assert rows[5, "http://a.com/fr/"]["verdict"] == "allow"
    assert (rows[7, "://host#frag"]["host"], rows[7, "://host#frag"]["path"]) == ("host", "")
    assert urls.judge_urls(pages.where("false"), queries.URL_RULES).collect() == []


def test_odd_pages_come_back_from_the_archive(spark, pages):
    index = warc.write_bundles(pages, warc.archive_folder(spark))
    rows = sorted(warc.read_bundles(index).collect(), key=str)
    found = {(r["page_id"], r["record_type"], r["refers_to"]) for r in rows}
    assert len(rows) == len(PAGES)
    assert found == {
        (1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (4, "revisit", 5), (5, "response", None),
        (None, "revisit", 7), (7, "response", None), (6, "response", None),
    }
    assert {r["payload_bytes"] for r in rows if r["page_id"] == 6} == {200_000}
    raw = warc.read_record(spark, index, 7)
    assert raw.startswith(b"WARC/1.1\r\n") and b"<p>b</p>" in raw
    assert warc.read_record(spark, index, 99) is None
    empty = warc.write_bundles(pages.where("false"), warc.archive_folder(spark))
    assert warc.read_bundles(empty).collect() == []


def test_small_payloads_are_never_revisits(spark, pages):
    rows = warc.read_bundles(warc.write_bundles(pages, warc.archive_folder(spark), least=9)).collect()
    assert {r["record_type"] for r in rows} == {"response"}
