"""Every query against DuckDB over the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from jobtide.plans.catalog import QUERIES
from jobtide.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", f"{TESTDATA}/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    # repr keeps 1 and 1.0 apart, so a column of the wrong type shows up.
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


# Queries without SQL have tests of their own.
@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = _rows(names, cursor.fetchall())
    actual = _rows(result.columns, [tuple(r) for r in result.collect()])
    assert expected, "a query without rows checks nothing"
    assert [repr(r) for r in actual] == [repr(r) for r in expected]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == [
        "published_date",
        "total_vacancies",
        "avg_salary",
        "cities_count",
    ]
