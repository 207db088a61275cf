"""The contracts that SQL can express, against DuckDB on the same tables."""

import os

import duckdb
import pytest

from gridloom.llm import queries as q

TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_duckdb(spark, name):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    for table in os.listdir(folder):
        connection.execute(f"create view {table[:-8]} as select * from '{folder}/{table}'")
    frame = q.queries()[name](spark, folder)
    cursor = connection.execute(q.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert {c: TYPES[t] for c, t in frame.dtypes} == {c[0]: str(c[1]) for c in cursor.description}
    assert sorted((tuple(r) for r in frame.select(*names).collect()), key=str) == sorted(cursor.fetchall(), key=str)
