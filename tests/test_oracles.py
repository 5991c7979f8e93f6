"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from conftest import DATA
from spanlake.checks.oracles import ORACLES
from spanlake.checks.registry import queries


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else float(f"{value:.12g}")
        return value

    return sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, DATA)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(names, expected.fetchall())
    assert got, "a query over the test data returns rows"
    assert len(got) == len(want)
    assert [g for g, w in zip(got, want) if g != w][:3] == [w for g, w in zip(got, want) if g != w][:3]


def test_every_query_has_sql():
    assert set(queries()) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0
