"""The queries that SQL can express, against that SQL on the same tables."""

import duckdb
import pytest

from folioflow.llm import queries


def plain(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    folder = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        duck.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert len(got) == len(want) and [(a, b) for a, b in zip(got, want, strict=True) if a != b][:5] == []
