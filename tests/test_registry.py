import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()
SLOW = {"train_forest", "train_boosted", "stream_incremental"}
# The text operators have tests of their own.
OTHERS = {*contract.corpus.QUERIES, "pipeline"} if contract.corpus else set()


@pytest.fixture(scope="module")
def tables(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW - OTHERS))
def test_query_equals_sql(spark, folder, tables, name):
    df = QUERIES[name](spark, folder)
    rows = df.collect()
    if name in SQL:
        cursor = tables.execute(SQL[name])
        assert normal(df.columns, rows) == normal([c[0] for c in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
