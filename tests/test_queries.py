"""Every registered query against DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = {name: query for name, query in driver.queries().items() if name.startswith("q_")}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name.startswith("q_")}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6)
    return int(value) if hasattr(value, "as_integer_ratio") and not isinstance(value, float) else value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(repr(tuple(_plain(row[place]) for place in order)) for row in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(result.columns) == sorted(columns)
    actual = [tuple(row) for row in result.collect()]
    assert len(actual) == len(expected)
    assert len(actual) > 0
    assert _sorted_rows(result.columns, actual) == _sorted_rows(columns, expected)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() == 572
    assert result.select("user_id").distinct().count() == 155
