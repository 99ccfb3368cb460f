"""Every registered query against its SQL, whole tables, by value."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.01")


# The operators on training text are tested with their subpackage; all others must have SQL.
QUERIES = getattr(entry, "_own_queries", entry.queries)
SQL = getattr(entry, "_own_sql", entry.oracle_sql)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


def test_every_query_has_sql():
    assert QUERIES().keys() == SQL().keys()


@pytest.mark.parametrize("name", QUERIES())
def test_same_as_sql(spark, duck, name):
    found = QUERIES()[name](spark, str(FOLDER))
    expected = duck.execute(SQL()[name])
    names = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(names)
    assert rows(found.columns, found.collect()) == rows(names, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
