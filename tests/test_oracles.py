"""Every registered query against its SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "events", "conversations", "customer")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return tuple(plain(v) for v in value) if isinstance(value, (list, tuple)) else value


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert rows
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(dict(zip(names, r))[c]) for c in columns) for r in result.fetchall())
    assert rows == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "title" in df.columns
