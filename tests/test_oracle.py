"""Every registered query equals its independent SQL formulation (DuckDB)."""

import pytest

import __spark_entry__ as entry
from aerolake.plans.oracle import oracle_queries
from aerolake.plans.register import queries
from conftest import SF_SMALL
from oracle_compare import compare, duck

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(queries())
    assert set(queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(queries()[name](spark, SF_SMALL), con, oracle_queries()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["snapshot_timestamp", "snapshot_date", "snapshot_hour", "country_of_origin"]
