"""Fits that are kept per day, merged and applied, against numpy and the fits of whole tables."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import fits, scaling
from tidemark.streaming import headlines as streaming

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DAY0 = dt.date(2021, 3, 1)


def frame(spark, values, days=5):
    rows = [(k, DAY0 + dt.timedelta(days=k % days), None if v is None else float(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, day date, x double")


@FEW
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), max_size=40), st.sampled_from([0.0, 1e9]))
def test_merged_states_are_those_of_the_whole(spark, values, far):
    values = [None if v is None else v + far for v in values]
    df = frame(spark, values)
    known = np.array([v for v in values if v is not None])
    for parts in (fits.fit_states(df, "x", ["day"]), fits.fit_states(df.where("id % 2 = 0"), "x").unionAll(fits.fit_states(df.where("id % 2 = 1"), "x"))):
        state = fits.merge_states(parts.drop("day")).head()
        if not len(known):
            assert (state["n"] or 0) == 0 and state["mean"] is None
            continue
        assert state["n"] == len(known) and (state["lo"], state["hi"]) == (known.min(), known.max())
        assert state["mean"] == pytest.approx(known.mean(), rel=1e-12)
        assert state["m2"] == pytest.approx(((known - known.mean()) ** 2).sum(), rel=1e-6, abs=1e-3)


def test_merging_is_pairwise(spark):
    """Any order of merges gives the same state, and keys are kept apart, a null one too."""
    df = frame(spark, np.random.default_rng(1).normal(5e8, 3, 200)).withColumn("k", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    parts = [fits.fit_states(df.where(F.col("id") % 4 == p), "x", ["k"]) for p in range(4)]
    left = fits.merge_states(fits.merge_states(parts[0].unionAll(parts[1]), ["k"]).unionAll(parts[2]), ["k"])
    chained = fits.merge_states(left.unionAll(parts[3]), ["k"])
    whole = fits.fit_states(df, "x", ["k"])
    got, want = ({r["k"]: r for r in x.collect()} for x in (chained, whole))
    assert set(got) == set(want) == {None, 1, 2}
    for k in want:
        assert (got[k]["n"], got[k]["lo"], got[k]["hi"]) == (want[k]["n"], want[k]["lo"], want[k]["hi"])
        assert got[k]["mean"] == pytest.approx(want[k]["mean"], rel=1e-14) and got[k]["m2"] == pytest.approx(want[k]["m2"], rel=1e-6)


def test_values_that_are_no_numbers_count_for_nothing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    state = fits.merge_states(fits.fit_states(df, "x")).head()
    assert tuple(state) == (2, 2.0, 2.0, 1.0, 3.0)


def test_only_changed_days_are_read_and_written(spark, tmp_path):
    rows, states = str(tmp_path / "rows"), str(tmp_path / "states")
    df = frame(spark, range(50))
    df.write.partitionBy("day").parquet(rows)
    stored = spark.read.schema("id int, x double, day date").parquet(rows)
    fits.store_states(stored, "x", "day", states)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").glob("day=*/*.parquet")}
    changed, gone = DAY0 + dt.timedelta(days=2), DAY0 + dt.timedelta(days=4)
    spark.createDataFrame([(99, 1e6)], "id int, x double").write.mode("append").parquet(f"{rows}/day={changed}")
    for file in (tmp_path / "rows" / f"day={gone}").iterdir():
        file.unlink()
    (tmp_path / "rows" / f"day={DAY0}" / "broken.parquet").write_text("a day that is not read again")
    spark.catalog.refreshByPath(rows)
    now = spark.read.schema("id int, x double, day date").parquet(rows)
    fits.store_states(now, "x", "day", states, [changed, gone])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").glob("day=*/*.parquet")}
    kept = {p for p in before if f"day={changed}" not in str(p) and f"day={gone}" not in str(p)}
    assert kept and {p: after.get(p) for p in kept} == {p: before[p] for p in kept}
    state = fits.merge_states(fits.load_states(spark, states)).head()
    values = np.array([k for k in range(50) if k % 5 != 4] + [1e6])
    assert (state["n"], state["hi"]) == (41, 1e6) and state["m2"] == pytest.approx(((values - values.mean()) ** 2).sum())
    assert fits.load_states(spark, states).where(F.col("day") == gone).head()["n"] == 0


def test_a_kept_fit_scales_tables_like_a_fresh_one(spark):
    df = frame(spark, [3, 9, 4, 4, None, 8, 1, 7])
    state = fits.merge_states(fits.fit_states(df, "x", ["day"])).head()
    for kind, fresh in (("min_max", scaling.min_max), ("z_score", scaling.z_score)):
        got = [r["s"] for r in fits.scale_with(df, "x", "s", state, kind).orderBy("id").collect()]
        want = [r["s"] for r in fresh(df, "x", "s").orderBy("id").collect()]
        assert got == pytest.approx(want)
    per_day = fits.fit_states(df, "x", ["day"])
    got = [r["s"] for r in fits.scale_by_key(df, "x", "s", per_day, "day", "min_max").orderBy("id").collect()]
    assert got == pytest.approx([r["s"] for r in scaling.min_max(df, "x", "s", by="day").orderBy("id").collect()])
    with pytest.raises(ValueError, match="kind"):
        fits.scale_with(df, "x", "s", state, "other")


def test_constant_and_empty_fits(spark):
    df = frame(spark, [2, 2])
    state = fits.merge_states(fits.fit_states(df, "x")).head()
    assert [r["s"] for r in fits.scale_with(df, "x", "s", state).collect()] == [0.5, 0.5]
    assert [r["s"] for r in fits.scale_with(df, "x", "s", state, "z_score").collect()] == [0.0, 0.0]
    none = fits.merge_states(fits.fit_states(df.where("false"), "x")).head()
    assert [r["s"] for r in fits.scale_with(df, "x", "s", none, "z_score").collect()] == [None, None]


def test_a_kept_fit_scales_a_stream(spark, tmp_path):
    df = frame(spark, range(10))
    df.write.parquet(str(tmp_path / "in"))
    state = fits.merge_states(fits.fit_states(df, "x", ["day"])).head()
    rows = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = streaming.start(fits.scale_with(rows, "x", "s", state, "z_score"), str(tmp_path / "c"), "parquet", str(tmp_path / "out"), available_now=True)
    query.awaitTermination()
    got = {r["id"]: r["s"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    values = np.arange(10.0)
    assert got == pytest.approx(dict(enumerate((values - values.mean()) / values.std())))
