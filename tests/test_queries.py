"""Every query against its SQL twin on DuckDB."""

import pytest

import __spark_entry__ as contract
from testbed import compare, oracle, queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(queries.ALL) == set(oracle.ALL)
    assert set(queries.ALL) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert {"bus_id", "distancia_m", "eta_min"} <= set(result.columns)


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_same_rows(spark, duck, sf_dir, name):
    assert compare.differences(spark, duck, queries.ALL[name], oracle.ALL[name], sf_dir) is None
