"""Every registered query against its DuckDB oracle (driver-style check)."""

import pytest

import __spark_entry__ as entry
from quayside.plans.registry import QUERIES
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
# the queries of the training-data subpackage have tests of their own
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r
    assert not r["type_mismatches"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:7] == ["event_id", "event_type", "timestamp", "payload", "source", "metadata",
                              "processed_at"]
