"""Every query with SQL, against DuckDB on the same tables; the others run and give rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(testdata):
    con = duckdb.connect()
    for file in sorted(os.listdir(testdata)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{testdata}/{file}'")
    return con


def ordered(rows, columns):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(row[p]) for p in places) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, duck, testdata):
    df = QUERIES[name](spark, testdata)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = ordered([tuple(r) for r in df.collect()], df.columns)
    assert got and got == ordered(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_gives_rows(name, spark, testdata):
    assert not QUERIES[name](spark, testdata).isEmpty()


def test_flagship(spark, testdata):
    assert entry.entry(spark).count() == 3
