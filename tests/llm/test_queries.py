"""Every registered query against its SQL over the same tables."""

import duckdb
import pytest

from bustrace.llm import oracle, queries

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        connection.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return connection


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(oracle.oracle_sql()) < set(queries.queries())


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query(spark, sql, name):
    found = queries.queries()[name](spark, DIR)
    result = sql.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)
    wanted = sorted([str(r[names.index(c)]) for c in found.columns] for r in result.fetchall())
    assert sorted([str(x) for x in r] for r in found.collect()) == wanted
    assert wanted
