import random

from folioflow.operators import control
from folioflow.plans import queries as plans


def waits(calls, rate):
    """(key, t, wait) of every call, one key after the other, call by call."""
    out = []
    for key in {k for k, _, _ in calls}:
        level, last = rate, None
        for t, n in sorted((t, n) for k, t, n in calls if k == key):
            level = rate if last is None else min(rate, level + (t - last) * rate)
            last, level = t, level - n
            out.append((key, t, max(0.0, -level / rate)))
    return out


def rounded(rows):
    return sorted((str(k), t, round(w, 6)) for k, t, w in rows)


def test_blocks_carry_the_level(spark):
    r = random.Random(5)
    calls = [(r.choice(["a", "a", "a", "b", None]), float(r.choice([r.randrange(400), 77])), float(r.randrange(1, 4))) for _ in range(600)]
    calls += [("full", float(1000 * i), 1.0) for i in range(30)] + [("late", 5.0, 9.0)]
    got = control.token_bucket_waits(spark.createDataFrame(calls, "key string, t double, n double"), 2.0, block=40).collect()
    want = waits(calls, 2.0)
    assert sum(w > 0 for _, _, w in want) > 100 and rounded(map(tuple, got)) == rounded(want)
    assert control.token_bucket_waits(spark.createDataFrame([], "key string, t double, n double"), 2.0).count() == 0


def test_query_takes_every_event(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_type", "unix_seconds(cast(ts as timestamp)) / 3600.0D").collect()
    got = plans.queries()["token_bucket_waits"](spark, folder).collect()
    assert len(got) == len(rows) and rounded(map(tuple, got)) == rounded(waits([(k, t, 1.0) for k, t in rows], 1.0))
