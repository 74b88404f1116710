"""Every query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_points
from flowkit.catalog import QUERIES, SQL
from tests.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    assert difference(frame, duck, SQL[name]) is None


def test_no_result_is_empty(duck):
    for name, sql in SQL.items():
        assert duck.execute(f"SELECT count(*) FROM ({sql})").fetchall()[0][0] > 0, name


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
