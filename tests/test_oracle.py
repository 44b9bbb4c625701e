"""Registered queries against their SQL on the smallest tables."""

import re
from datetime import date

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, rows_of

NAMES = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, sf_dir, database, name):
    result = contract.queries()[name](spark, sf_dir)
    relation = database.sql(contract.oracle_sql()[name])
    rows = result.collect()
    assert rows_of(result.columns, rows) == rows_of(relation.columns, relation.fetchall())
    assert not any(isinstance(value, date) for row in rows[:1] for value in row)


def test_contract(spark, sf_dir):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    without = {name for name in contract.queries() if not re.match(r"op[0-9]+_|pipeline$", name)}
    assert without - set(contract.oracle_sql()) == {"archive_manifest"}
