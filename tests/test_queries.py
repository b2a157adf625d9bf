"""Every query against its reference SQL on the smallest data."""

import duckdb
import pytest

from checks import all_queries
from checks.inputs import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("query", all_queries(), ids=lambda q: q.name)
def test_query(spark, duck, query):
    df = query.spark(spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    text = query.oracle()
    if text is None:
        assert got
        return
    cursor = duck.execute(text)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


def test_contract_needs_no_session():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
