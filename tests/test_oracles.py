"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TIDEMARK_TABLES", entry.SMALL)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


NAMES = list(entry.queries())


def comparable(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value).removesuffix("+00:00")


def sorted_rows(rows):
    return sorted((tuple(comparable(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = database.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert sorted_rows(rows) == sorted_rows(expected)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["year_month", "avg_drawdown_per_day"]
