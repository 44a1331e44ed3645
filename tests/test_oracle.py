"""Every query with SQL gives exactly the rows of that SQL."""

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def lines(table, columns):
    return sorted(str(tuple(r[c] for c in columns)) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, FOLDER)
    expected = duck.sql(entry.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    sql_types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: TYPES[t] for c, t in result.dtypes} == sql_types
    assert lines(result.toArrow(), columns) == lines(expected.to_arrow_table(), columns)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5000
