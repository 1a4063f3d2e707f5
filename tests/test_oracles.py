"""Every registered query against its SQL, and the driver's entry points."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import compare, oracle_connection
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("query", sorted(ORACLES))
def test_query_matches_oracle(spark, connection, sf_dir, query):
    assert compare(spark, connection, sf_dir, query) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[-4:] == ["_ingestion_time", "year", "month", "day"]
    assert result.count() > 0
