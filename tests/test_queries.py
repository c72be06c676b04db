"""Every query against the SQL of another engine, on the same tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from folioflow.plans import queries as plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float | decimal.Decimal):
        return f"{float(x):.6g}"
    if isinstance(x, datetime.datetime | datetime.date):
        return str(x)
    return str(x)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, "/root/testdata/sf0.01")
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(plans.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["context_budget", "chunk_windows", "html_flat_text", "token_bucket_waits", "breaker_states"])
def test_queries_without_sql_run(spark, name):
    assert plans.queries()[name](spark, "/root/testdata/sf0.01").count() > 0
