"""Queries over the text tables against their SQL answers, over the whole tables."""

import pytest

from pulsemart.checks.compare import connect, differences
from pulsemart.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []
