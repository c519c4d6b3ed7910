"""Every registered query against DuckDB on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from lakeops.checks import ORACLES, QUERIES
from tests.oracle import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, SF_DIR, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["section", "label", "n"]
    assert rows.count() > 0
