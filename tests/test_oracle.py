"""Every catalogue query with a SQL twin gives the same rows, types and column names."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _rows(frame.columns, frame.collect()) == _rows(columns, result.fetchall())
