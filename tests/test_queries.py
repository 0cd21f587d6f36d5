"""Every registered query against its SQL, on the smallest given tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
# The queries of the optional subpackage have their tests beside its own.
QUERIES = {k: v for k, v in entry_points.queries().items() if k not in entry_points.LLM_QUERIES}
ORACLES = {k: v for k, v in entry_points.oracle_sql().items() if k not in entry_points.LLM_QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return "null" if value is None or (isinstance(value, float) and math.isnan(value)) else repr(value)

    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in data)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert comparable(result.columns, [tuple(r) for r in result.collect()]) == comparable(columns, expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 15
