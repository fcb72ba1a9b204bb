"""Every registered query against its SQL answer, over the whole tables."""

import pytest

import __spark_entry__ as entry_points
from pulsemart.checks.compare import connect, differences
from pulsemart.checks.oracles import ORACLES
from pulsemart.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
ROWS_ONLY = {"source_inventory", "raw_preview", "stream_late_drop"}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []


def test_every_query_has_an_answer_or_is_known_not_to():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    shares = entry_points.entry(spark).collect()
    assert sum(r["share"] for r in shares) == pytest.approx(1.0)


def test_entry_points_are_complete():
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert entry_points.oracle_sql().items() >= ORACLES.items()
