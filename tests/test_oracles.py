"""Every registered query against its SQL on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from barlake.plans.catalog import all_queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES = {name: entry.run for name, entry in all_queries().items()}
ORACLES = {name: entry.oracle for name, entry in all_queries().items() if entry.oracle}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows(result.columns, result.collect()) == rows(columns, cursor.fetchall())


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
