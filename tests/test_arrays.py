"""JSON objects broken over lines against Python's own reader and Spark's multi-line reader."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark import schemas
from tidemark.sources import arrays, files

FEW = settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.text(st.sampled_from('ab{}[]",:\\\n é漢'), max_size=12)
VALUE = st.recursive(st.one_of(st.none(), st.integers(), TEXT), lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(TEXT, v, max_size=3)), max_leaves=8)


def by_ranges(text, width):
    """The objects of a text read in ranges as the reader cuts them, put together."""
    chunks, at = [], 0
    pieces = text.split("}")
    for k, piece in enumerate(pieces):
        if k < len(pieces) - 1 or piece:
            chunks.append((at, piece))
        at += len(piece) + 1
    ranges = {}
    for at, piece in chunks:
        ranges.setdefault(at // width * width, []).append(piece)
    effects = []
    for block, parts in ranges.items():
        outside, inside = arrays.Effect(False), arrays.Effect(True)
        for part in parts:
            outside, inside = outside.then(part), inside.then(part)
        effects.append((block, outside, inside))
    whole, broken = [], {}
    for block, start in arrays.starts(effects).items():
        for began, part in arrays.cut(iter(ranges[block]), start, block):
            if began is None:
                whole.append(part)
            else:
                broken.setdefault(began, []).append((block, part))
    return whole + ["".join(p for _, p in sorted(parts)) for parts in broken.values()]


def objects_of(value):
    """The outermost objects in lists of lists."""
    if isinstance(value, dict):
        return [value]
    return [x for v in value for x in objects_of(v)] if isinstance(value, list) else []


def told(values):
    return sorted(json.dumps(v, sort_keys=True) for v in values)


@FEW
@given(st.lists(VALUE, max_size=6), st.integers(1, 60), st.sampled_from([None, 1]), st.booleans())
def test_ranges_give_every_object_once(values, width, indent, ascii_only):
    text = json.dumps(values, indent=indent, ensure_ascii=ascii_only)
    assert told(map(json.loads, by_ranges(text, width))) == told(objects_of(values))


def test_strings_that_look_like_objects():
    value = [{"a": '}{"b": 1}', "c": {"d": '\\"}'}}, {"e": "\\"}, ["{", {"f": []}], {}]
    for width in (1, 2, 3, 7, 1000):
        assert told(map(json.loads, by_ranges(json.dumps(value), width))) == told(objects_of(value))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("arrays")
    rows = [
        {"id": str(k), "title": f'say "{k}" {{now}} }} \\ {"x" * (k % 50)}\nand é漢', "score": k, "media": {"a": [{"b": k}]}, "created_utc": 10**9 + k}
        for k in range(700)
    ]
    (out / "large.json").write_text(json.dumps(rows[:600], indent=2, ensure_ascii=False))
    (out / "one-line.json").write_text(json.dumps(rows[600:650]))
    (out / "lines.json").write_text("\n".join(json.dumps(r) for r in rows[650:]))
    (out / "empty.json").write_text("[]")
    (out / "nothing.json").write_text("")
    return str(out)


@pytest.mark.parametrize("split", [None, 997, 20_000])
def test_files_are_read_as_the_multi_line_reader_does(spark, folder, split):
    got = arrays.read_json_arrays(spark, folder, schemas.RAW_HEADLINE, split).select("id", "title", "score", "created_utc")
    large = files.read_headlines(spark, f"{folder}/large.json", multi_line=True).select(*got.columns)
    assert sorted(int(r["id"]) for r in got.collect()) == list(range(700))
    assert large.exceptAll(got).isEmpty() and large.count() == 600
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "997"


def test_a_large_file_has_many_tasks(spark, folder, monkeypatch):
    seen = []
    plain = arrays.staged
    monkeypatch.setattr(arrays, "staged", lambda df, name: seen.append(df.rdd.getNumPartitions()) or plain(df, name))
    arrays.json_objects(spark, f"{folder}/large.json", 5000)
    assert seen[0] > 10


def test_an_object_cut_off_by_the_end_of_its_file_is_closed(spark, tmp_path):
    (tmp_path / "cut.json").write_text('[{"id": "1"}, {"id": "2", "score": 5')
    rows = arrays.read_json_arrays(spark, str(tmp_path / "cut.json")).select("id", "score").collect()
    assert sorted(map(tuple, rows)) == [("1", None), ("2", 5)]


def test_small_ranges_are_read_several_to_a_task(spark, tmp_path, monkeypatch):
    rows = [{"id": str(k), "title": "a {b} \"c\" " * (k % 40)} for k in range(3000)]
    (tmp_path / "whole.json").write_text(json.dumps(rows, indent=1))
    tasks, run = [], arrays.staged
    monkeypatch.setattr(arrays, "staged", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or run(df, name))
    got = arrays.read_json_arrays(spark, str(tmp_path / "whole.json"), split_bytes=1 << 10)
    assert sorted((r["id"], r["title"]) for r in got.select("id", "title").collect()) == sorted((r["id"], r["title"]) for r in rows)
    assert tasks == [2 * spark.sparkContext.defaultParallelism] and (tmp_path / "whole.json").stat().st_size > 500 << 10
