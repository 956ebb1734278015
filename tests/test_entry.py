"""The driver contract on the smallest tables: every query against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in places] for row in rows), key=lambda row: [(v is None, str(v)) for v in row])


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry_module.queries()[name](spark, SMALL)
    answer = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert {c: TYPES[t] for c, t in frame.dtypes} == {d[0]: str(d[1]) for d in answer.description}
    got = ordered([tuple(r) for r in frame.collect()], frame.columns)
    assert got == ordered(answer.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
