"""Every registered query again, on tables in which a third of the rows share a key or a text."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from lamina.plans import table_queries
from tests.test_entry import SF, TABLES, canonical

# Table, column made hot, the id that picks a third of its rows, and the shared value.
HOT = [
    ("orders", "o_custkey", "o_orderkey", 7),
    ("lineitem", "l_orderkey", "l_linenumber", 5),
    ("lineitem", "l_partkey", "l_linenumber", 9),
    ("lineitem", "l_suppkey", "l_linenumber", 3),
    ("events", "user_id", "event_id", 1),
    ("documents", "text", "doc_id", "a, b;c|d,e\n"),
    ("pages", "url", "page_id", "https://h.example.com/en/x?y"),
    ("labels", "doc_id", "doc_id", 3),
]


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name in TABLES:
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        for column, picked_by, value in [h[1:] for h in HOT if h[0] == name]:
            shared = F.when(F.col(picked_by) % 3 == 0, F.lit(value)).otherwise(F.col(column))
            df = df.withColumn(column, shared.cast(df.schema[column].dataType))
        df.repartition(3).write.parquet(f"{root}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")
    return str(root), con


@pytest.mark.parametrize("name", sorted(table_queries.QUERIES))
def test_query_on_hot_tables(spark, hot, name):
    root, con = hot
    ours = driver.queries()[name](spark, root)
    theirs = con.sql(driver.oracle_sql()[name])
    assert canonical(ours.columns, ours.collect()) == canonical(theirs.columns, theirs.fetchall())
