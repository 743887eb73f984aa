"""Registered queries beside their SQL, on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, compare
from millrace.checks.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")

# Streams are covered by their own tests.
NAMES = [n for n in REGISTRY if not n.startswith(("stream_", "console_"))]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql_or_a_reason():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(REGISTRY) - set(contract.oracle_sql()) == set()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    line = compare(spark, db, name, contract.queries()[name], contract.oracle_sql()[name], FOLDER)
    assert line.startswith("equal"), line
