"""Every registered query against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans.oracle_sql import ORACLES
from millrace.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return connection


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    types = dict(zip(want.columns, (str(t).replace(" ", "") for t in want.types)))
    assert {c: TYPES.get(t, t.upper()).replace(" ", "") for c, t in df.dtypes} == types
    assert bag(df.columns, df.collect()) == bag(want.columns, want.fetchall())
    assert df.limit(1).count() == 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "channel", "revenue", "orders"]
    assert df.limit(1).count() == 1
