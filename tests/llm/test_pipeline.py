"""The pipeline's stages, each on what the one before has kept."""

import pytest

import corpus_pipeline
from tidemark.llm import mixing, near, packing, queries, spans, toxicity
from tidemark.llm.common import table
from tidemark.session import staged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF))
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(spark, steps):
    for _, after in steps[:-1]:
        assert sorted(after.dtypes) == sorted(table(spark, SF, "documents").dtypes)


def test_toxic_documents_go(spark, steps):
    before, after = steps[0]
    scored = toxicity.score(before, toxicity.fit(before, table(spark, SF, "labels"))).where(f"score < {queries.TOXIC_FROM}")
    assert ids(after) == ids(scored) and len(ids(after)) > 0.8 * len(ids(before))


def test_one_document_of_each_group_stays(steps):
    before, after = steps[1]
    found = near.near_duplicates(before, 5, 80)
    assert ids(after) == {r["component_id"] for r in found.collect()}
    assert near.near_duplicates(after, 5, 80).where("not kept").isEmpty()


def test_repeated_sentences_go(steps):
    before, after = steps[2]
    texts = {r["doc_id"]: r["text"] for r in spans.remove_repeats(before).collect()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_rows_are_there_as_often_as_they_are_taken(steps):
    before, after = steps[3]
    wanted = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == wanted


def test_every_row_is_packed(steps):
    before, after = steps[4]
    assert after.where("start = 0").count() == before.count()
    assert set(after.columns) >= {"doc_id", "sequence_id", "offset"}
    assert packing.LENGTH == 1024


def test_run_applies_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert got.agg({"length": "sum", "ids_crc32": "sum"}).collect() == steps[-1][1].agg({"length": "sum", "ids_crc32": "sum"}).collect()
