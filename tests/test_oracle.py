"""Every registered query against plain SQL on the same tables."""

from __future__ import annotations

import pytest
from comparing import differences, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries
from winnower.plans.catalog import QUERIES
from winnower.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def oracle(data):
    connection = oracle_connection(data)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(queries()) >= set(QUERIES) and set(oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_as_sql(spark, data, oracle, name):
    assert differences(QUERIES[name](spark, data), oracle, ORACLE[name]) == []


def test_entry(spark):
    assert {row.branch for row in entry(spark).collect()} == {"valid", "dead", "undetermined"}
