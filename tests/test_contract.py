"""Every registered query against its SQL twin, whole tables, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
from tillstar.contract.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_flagship(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == want
    assert want
