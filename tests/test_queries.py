import duckdb
import pytest

import __spark_entry__ as contract
from ledgerloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows, columns):
    wanted = sorted(columns)
    picked = [tuple(row[columns.index(name)] for name in wanted) for row in rows]
    return sorted(picked, key=lambda row: tuple((value is not None, str(value)) for value in row))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    relation = duck.sql(contract.oracle_sql()[name])
    got = contract.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(relation.columns)
    rows = [tuple(row) for row in got.collect()]
    expected = ordered(relation.fetchall(), list(relation.columns))
    assert ordered(rows, got.columns) == expected and expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
