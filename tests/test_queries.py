"""Every registered query against its DuckDB twin (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck

NAMES = sorted(entry.catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, _, _, detail = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert ok, detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "mae" in df.columns
