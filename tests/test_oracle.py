"""Every registered query runs, and those with SQL give the same rows (small scale)."""

import os

import duckdb
import pytest

from provatab.plans.all_queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else repr(value)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def test_sql_is_only_given_for_registered_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    if name in ORACLE:
        cursor = duck.execute(ORACLE[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, got) == rows_of(columns, cursor.fetchall())
