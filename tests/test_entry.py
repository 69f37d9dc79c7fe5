"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from lamina.plans import table_queries

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in values)


def test_entry(spark):
    assert driver.entry(spark).count() == 150


def test_every_query_has_its_sql():
    assert set(table_queries.QUERIES) == set(table_queries.ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(table_queries.QUERIES))
def test_query(spark, database, name):
    ours = driver.queries()[name](spark, SF)
    theirs = database.sql(driver.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours.columns, ours.collect()) == canonical(theirs.columns, theirs.fetchall())
