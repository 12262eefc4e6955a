"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import load_all
from tidemark.plans.catalog import ORACLE, QUERIES
from tools.check_oracle import TABLES, rows

load_all()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert got
        return
    relation = duck.execute(ORACLE[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, relation.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
