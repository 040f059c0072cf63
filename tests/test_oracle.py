"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(compare.catalog.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, db, name):
    assert compare.difference(spark, db, name, SF) is None


def test_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 30
    assert {0.0, 1.0} <= {row["normalized_avg"] for row in rows}
