"""Every query with a SQL counterpart gives the same rows on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value if value is None or isinstance(value, (bool, int)) else str(value)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(entry_point.queries())
    assert len(ORACLE) >= 45


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    relation = duck.execute(ORACLE[name])
    names = [c[0] for c in relation.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in relation.fetchall()), key=repr)
    got = sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)
    assert got == want
