"""Every named query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return None if math.isnan(value) else round(float(value), 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got
        return
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
