"""Session versions against a replay of every batch."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioflow.llm import late_sessions

SCHEMA = "user long, s long, batch long, h long"


def replayed(rows, gap):
    users, out = defaultdict(list), []
    for user, s, batch, h in rows:
        if None not in (user, s, batch):
            users[user].append((s, batch, h))
    for user, events in users.items():
        standing = []
        for batch in sorted({b for _, b, _ in events}):
            groups = []
            for e in sorted(e for e in events if e[1] <= batch):
                if groups and e[0] - groups[-1][-1][0] <= gap:
                    groups[-1].append(e)
                else:
                    groups.append([e])
            for g in groups:
                new = sum(b == batch for _, b, _ in g)
                if new:
                    start, end = g[0][0], g[-1][0]
                    gone = [v for v in standing if start <= v[2] and v[3] <= end]
                    for v in gone:
                        v[8:] = batch, start
                        standing.remove(v)
                    standing.append([user, batch, start, end, len(g), new, len(gone), sum(h for _, _, h in g), None, None])
                    out.append(standing[-1])
    return sorted(map(tuple, out), key=str)


def got(df, *args):
    return sorted(map(tuple, df_versions(df, *args).collect()), key=str)


def df_versions(df, gap=240, tile=1200):
    return late_sessions.versions(df, gap, tile)


@pytest.mark.parametrize("gap, tile, times, batches", [(240, 1200, 9000, 3), (100, 100, 20000, 40), (30, 60, 2000, 300)])
def test_random_events(spark, gap, tile, times, batches):
    rnd = random.Random(gap)
    rows = [(rnd.randrange(5), rnd.randrange(-times // 4, times), rnd.randrange(batches), rnd.randrange(1 << 32)) for _ in range(600)]
    rows += rows[:20]
    assert got(spark.createDataFrame(rows, SCHEMA), gap, tile) == replayed(rows, gap)


def test_one_user_with_most_rows_over_many_tiles(spark):
    rnd = random.Random(7)
    rows = [(1, s := 150 * i + rnd.randrange(100), s // 1800 + rnd.choice([0, 0, 1, 3, 25]), i) for i in range(1500)] + [(2, 5, 0, 9)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == replayed(rows, 240)


def test_odd_rows(spark):
    rows = [(None, 1, 1, 1), (1, None, 1, 1), (1, 1, None, 1), (1, 10, 2, 5), (1, 10, 2, 5), (1, 10, 0, 7), (1, 250, 1, 1), (1, 491, 0, 2)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == replayed(rows, 240)
    assert df_versions(spark.createDataFrame([], SCHEMA)).collect() == []


def test_conversations_with_clashing_columns(spark):
    rows = [(None, 1, "user", 3), (7, None, "user", 3), (7, 0, None, 3), (7, 0, None, 3), (-3, 2, "x", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, user string, s int")
    events = late_sessions.conversation_events(df)
    assert events.count() == 3 and events.where("user = -2 or user = -1").count() == 1
    assert df_versions(events).agg(F.sum("n_new")).first()[0] == 3
