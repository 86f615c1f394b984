"""Every registered query against its SQL over the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import oracle
from catalog import queries as registered

DIR = "/root/testdata/sf0.001"
# Their point is that nothing is found.
EMPTY = {"search_no_topics", "search_unknown_field", "coordinates_held_twice"}
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return connection


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([str(r[i]) for i in order] for r in data)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())
    assert set(registered.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, sql, name):
    found = entry.queries()[name](spark, DIR)
    result = sql.execute(entry.oracle_sql()[name])
    wanted = rows([d[0] for d in result.description], result.fetchall())
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == wanted
    assert wanted[1] or name in EMPTY


def test_entry(spark):
    assert entry.entry(spark).count() > 0
