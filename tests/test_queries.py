"""Every registered query against its SQL twin on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows_of
from demandflow.checks import oracle, registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, TWINS = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_twins_belong_to_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(TWINS) <= set(entry.oracle_sql())
    assert set(TWINS) <= set(QUERIES)
    assert set(QUERIES) - set(TWINS) == {"model_mae", "glm_forecast", "model_choice"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    if name not in TWINS:
        assert got.num_rows > 0
        return
    want = db.sql(TWINS[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
