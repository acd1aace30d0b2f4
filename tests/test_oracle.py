"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from custmaster.plans.queries import REGISTRY
from oracle_harness import compare, duck

QUERIES = {k: f for k, f in entry.queries().items() if k in REGISTRY}
KEYS = list(QUERIES)
ORACLES = {k: s for k, s in entry.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(ORACLES) == set(REGISTRY)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF_ORACLE, key, QUERIES[key], ORACLES[key])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["ID_TYPE", "ID_NO", "SOURCE"]
