"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import duckdb_on, duckdb_result, spark_result

import __spark_entry__ as entry_points
from registry.oracles import ORACLES
from registry.queries import QUERIES

DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return duckdb_on(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_twin(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    assert spark_result(df) == duckdb_result(oracle, ORACLES[name])
    described = oracle.execute("DESCRIBE " + ORACLES[name]).fetchall()
    twin_types = {column: kind for column, kind, *_ in described}
    ours = {c: DUCKDB_TYPES.get(t, t.upper()) for c, t in df.dtypes}
    assert ours == twin_types


def test_entry_points(spark):
    result = entry_points.entry(spark)
    assert result.count() == 1
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.keys() <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()
