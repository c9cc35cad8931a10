"""Every registered query against its SQL, on the smallest sample."""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 2047


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        result = db.execute(sql)
        assert got == canonical([d[0] for d in result.description], result.fetchall())
