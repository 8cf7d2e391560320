"""Every named query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from conftest import MEDIUM

import __spark_entry__ as entry_points
from ledgerstar.plans.query_set import QUERIES

ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(MEDIUM).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, Decimal):
        return f"{value:.6f}"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


# The text operators' queries have their own tests beside them.
NAMES = sorted(QUERIES)


def test_every_query_has_sql():
    assert set(ORACLES) >= set(NAMES)
    assert set(ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, oracle, name):
    df = entry_points.queries()[name](spark, MEDIUM)
    result = oracle.execute(ORACLES[name])
    expected = rows_by_name([c[0] for c in result.description], result.fetchall())
    assert rows_by_name(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert expected[1]


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
