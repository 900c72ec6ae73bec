"""Every registered query with SQL agrees with DuckDB, value for value."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return float(v) if isinstance(v, (int, float, decimal.Decimal)) else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = ordered(cur.fetchall())
    got = ordered(df.select(*[f"`{n}`" for n in names]).collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
