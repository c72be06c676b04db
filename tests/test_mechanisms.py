"""Data source, VARIANT facts, table function, sketches, close values, gated publishing and keyed state."""

import datetime
import random
import uuid

import pytest
from pyspark.sql import functions as F

from folioflow.functions.text import iso_day
from folioflow.operators import bands, chunk_function, chunks, sketches
from folioflow.plans import records
from folioflow.sources import facts, index_source, landing, nested
from folioflow.sources.tables import scratch
from folioflow.streaming import fresh, publish


@pytest.fixture
def indexes(tmp_path):
    for day, lines in {
        datetime.date(2024, 3, 29): ["1000|A Co|10-K|20240329|edgar/data/1000/0001-24-000001.txt", "12|B|10-Q|20240329|edgar/data/12/0002.txt"],
        datetime.date(2024, 4, 2): ["--------", "x|B|10-Q|20240402|p", "7|C|8-K|20240402|p/0003.txt", "7|C|8-K|20241341|p/0003.txt", "7|C|8-K|20240403|p/0003.txt", "7|C|8-K", ""],
    }.items():
        at = tmp_path / landing.index_path("", day).lstrip("/")
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text("\n".join(["Description: x", "CIK|Company Name|Form Type|Date Filed|Filename", *lines]))
    return str(tmp_path)


def read(spark, path):
    index_source.register(spark)
    return spark.read.format("daily_index").options(path=path, start="2024-03-25", end="2024-04-10").load()


def test_daily_index_source(spark, indexes):
    got = read(spark, indexes)
    assert got.rdd.getNumPartitions() == 17
    assert sorted(map(tuple, got.collect())) == [
        ("0000000007", "C", "8-K", datetime.date(2024, 4, 2), "p/0003.txt", "0003"),
        ("0000000012", "B", "10-Q", datetime.date(2024, 3, 29), "edgar/data/12/0002.txt", "0002"),
        ("0000001000", "A Co", "10-K", datetime.date(2024, 3, 29), "edgar/data/1000/0001-24-000001.txt", "0001-24-000001"),
    ]
    by_line = landing.daily_index(spark, landing.index_path(indexes, datetime.date(2024, 3, 29)))
    assert sorted(map(tuple, by_line.collect())) == sorted(map(tuple, got.filter("filed = date'2024-03-29'").collect()))


def test_daily_index_pushes_filters(spark, indexes):
    few = read(spark, indexes).filter("filed >= date'2024-04-01' and filed < date'2024-04-03' and form in ('8-K', '10-K') and company like 'C%'")
    assert few.rdd.getNumPartitions() == 2 and few.count() == 1
    plan = few._jdf.queryExecution().executedPlan().toString()
    left = next(line for line in plan.split("\n") if "Filter (" in line)
    assert "StartsWith(company" in left and "form" not in left and "2024" not in left  # the source took the others over
    assert read(spark, indexes).filter("filed = date'2024-04-05'").collect() == []


def test_facts_through_variant(spark, tmp_path):
    rows = [("1", "t", "New:Tag", "USD", "12.5", "2024-01-01", "2024-12-31", "10-K", "2025-01-31", "a1"), ("1", "t", "New:Tag", "shares", "-3", None, "2024-12-31", "10-K", "x", "a2"), ("2", "u", "T", "USD", "no", "2024-02-30", None, None, None, "a3")]
    names = "cik taxonomy tag unit val start end form filed accn".split()
    path = str(tmp_path / "facts")
    facts.write_bodies(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), path)
    assert list((tmp_path / "facts").glob("*.json.gz"))
    (tmp_path / "facts" / "bad.json").write_text('{"cik": "9", "facts": {"t": \nnot json\n{"cik": "8"}\n{"cik": "7", "facts": 5}\n')
    got = sorted(map(tuple, facts.read_facts(spark, path).select("cik", "tag", "unit", "val", "start_d", "filed", "accn").collect()), key=str)
    assert [(g[0], g[1], g[2], None if g[3] is None else float(g[3]), g[4], g[5], g[6]) for g in got] == [
        ("1", "New:Tag", "USD", 12.5, datetime.date(2024, 1, 1), datetime.date(2025, 1, 31), "a1"), ("1", "New:Tag", "shares", -3.0, None, None, "a2"), ("2", "T", "USD", None, None, None, "a3")]


def test_facts_are_dealt_once_by_bodies_of_bounded_size(spark, tmp_path):
    rows = [("1", "t", f"T{i % 3}", "USD", str(i), "2024-01-01", None, "10-K", None, "one") for i in range(300)] + [(None, "t", "T", "USD", str(i), None, "2024-12-31", None, None, f"a{i}") for i in range(300)]
    rows += [(str(c), "t", "T", "USD", str(i), None, None, None, None, f"a{i}") for c in range(2, 40) for i in range(20)]
    rows = [(*r[:6], r[6] or f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", *r[7:]) for i, r in enumerate(rows)]
    names = "cik taxonomy tag unit val start end form filed accn".split()
    path = str(tmp_path / "facts")
    facts.write_bodies(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), path, 11, 20)
    bodies = spark.read.text(path).select(F.get_json_object("value", "$.cik").alias("cik"), (F.size(F.split("value", '"val":')) - 1).alias("n")).collect()
    assert max(b.n for b in bodies) < 100 and sum(b.cik == "1" for b in bodies) > 5 and sum(b.cik is None for b in bodies) > 5
    assert all(sum(b.cik == str(c) for b in bodies) == 1 for c in range(2, 40))  # a small company is one body
    got = facts.read_facts(spark, path).select("cik", "tag", F.col("val").cast("int").cast("string").alias("val"), F.col("start_d").cast("string"), F.col("end_d").cast("string"), "accn")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((r[0], r[2], r[4], r[5], r[6], r[9]) for r in rows), key=str)


def test_odd_facts_through_variant(spark, tmp_path):
    units = ['[{"val": true}, 7, null, {"val": "1e2"}, {"val": [1]}, {"val": 0.12345}, {"val": "true"}]', '{"a": {"val": 4}, "b": 5}', "5", "[]", "{}"]
    body = '{"cik": "%d", "facts": {"t": {"T": {"units": {"USD": %s}}}}}'
    (tmp_path / "a.json").write_text("\n".join([body % (i, u) for i, u in enumerate(units)] + ['{"cik": 9, "facts": [{"T": {"units": [[{"val": 3}]]}}]}']))
    got = facts.read_facts(spark, str(tmp_path)).select("cik", "taxonomy", "unit", F.col("val").cast("double")).collect()
    want = [("0", "t", "USD", v) for v in (1.0, None, None, 100.0, None, 0.1235, None)] + [("1", "t", "USD", 4.0), ("1", "t", "USD", None), ("9", None, None, 3.0)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_facts_do_not_carry_their_body(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"cik": "1", "facts": {}}')
    plan = facts.read_facts(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert all("body" not in line for line in plan.split("\n")[: plan[: plan.rindex("Generate")].count("\n") + 1])


def test_days_of_nested_facts_need_no_pattern(spark):
    rows = [('{"t": {"T": {"units": {"USD": [{"val": 1.5, "start": "2024-01-05", "filed": "2024-1-5"}, {"val": "no", "end": "2024-02-30"}]}}, "N": null}, "u": null}',), ("{}",), ("no json",), (None,)]
    got = nested.observations(spark.createDataFrame(rows, "body string"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 3
    shown = got.select("taxonomy", "tag", "unit", F.col("val").cast("string"), F.col("start_d").cast("string"), "end_d", "filed").collect()
    assert sorted(map(tuple, shown), key=str) == sorted([("t", "T", "USD", "1.5000", "2024-01-05", None, None), ("t", "T", "USD", None, None, None, None)], key=str)


@pytest.mark.parametrize("text", ["2024-02-29", "2023-02-29", "2024-1-5", "0000-01-01", "0001-01-01", "+10000-01-01", "10000-01-01", " 2024-01-01", "2024-01-01 ", "2024-01-01\n", "2024-01-01T00", "1582-10-10", "2024-00-10", "-2024-01-01", "", None])
def test_days_are_those_of_the_pattern(spark, text):
    df = spark.createDataFrame([(text,)], "c string").select(iso_day("c").cast("string").alias("a"), F.try_to_date("c", "yyyy-MM-dd").cast("string").alias("b"))
    assert df.filter("a <=> b").count() == 1


def test_chunk_function_gives_the_chunk_table(spark, sf):
    docs = records._filings(spark, sf).limit(40)
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("accession", F.lit("none")))
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(chunk_function.assembled(docs).select(*chunks.assembled(docs).columns)) == key(chunks.assembled(docs))


def test_chunk_function_needs_no_shuffle(spark, sf):
    docs = records._filings(spark, sf).limit(3).localCheckpoint()
    assert "Exchange" not in chunk_function.assembled(docs)._jdf.queryExecution().executedPlan().toString()


def test_chunk_function_in_sql(spark):
    chunk_function.register(spark)
    got = spark.sql("SELECT i, c.* FROM VALUES (1, repeat('word ', 300)), (2, null) AS t(i, x), LATERAL chunk_document(x, null, null, 100, 10, 5) c").collect()
    assert {r.i for r in got} == {1} and len(got) > 3 and [r.ordinal for r in got] == list(range(len(got)))


def test_sketches_answer_every_range(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    path = scratch(spark, "sketches")
    sketches.daily(e, "ts", "event_type", "user_id", "value").write.parquet(path)
    kept = spark.read.parquet(path)
    asked = [("all", "2024-01-01", "2024-01-31"), ("week", "2024-01-05", "2024-01-11"), ("overlaps", "2024-01-10", "2024-01-20"), ("day", "2024-01-03", "2024-01-03")]
    ranges = spark.createDataFrame(asked, "name string, a string, b string").select("name", F.to_date("a").alias("start"), F.to_date("b").alias("end"))
    got = sketches.ranges(kept, ranges, [0.5, 0.95]).collect()
    data = [(r.ts.date().isoformat(), r.event_type, r.user_id, r.value) for r in e.collect()]
    assert {(r.name, r.group) for r in got} == {(n, t) for n, a, b in asked for d, t, _, _ in data if a <= d <= b}
    for r in got:
        a, b = next((a, b) for n, a, b in asked if n == r.name)
        own = [x for x in data if a <= x[0] <= b and x[1] == r.group]
        assert r.n == len(own) and abs(r.n_distinct - len({x[2] for x in own})) <= 0.05 * len(own) + 1
        values = sorted(x[3] for x in own)
        for q, at in ((0.5, r.p50), (0.95, r.p95)):
            low, high = sum(v < at for v in values) / len(values), sum(v <= at for v in values) / len(values)
            assert low - 0.025 <= q <= high + 0.025


def test_close_values(spark):
    rnd = random.Random(2)
    left = [rnd.choice([1, -1]) * rnd.uniform(0.001, 1000) for _ in range(300)] + [0.0, 0.0, float("nan"), float("inf"), None, 100.0, 100.5, 99.5]
    right = [v * rnd.uniform(0.99, 1.01) for v in left[:300]] + [0.0, None, float("nan"), float("-inf"), 100.0, 100.0, 1e-300]
    a = spark.createDataFrame(list(enumerate(left)), "i long, x double")
    b = spark.createDataFrame(list(enumerate(right)), "j long, y double")
    got = bands.near(a, b, "x", "y")
    want = sorted((i, j) for i, x in enumerate(left) for j, y in enumerate(right) if x is not None and y is not None and abs(x) < float("inf") and abs(y) < float("inf") and abs(x - y) <= 0.005 * abs(y))
    assert sorted((r.i, r.j) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_close_values_are_counted_without_pairs(spark):
    rnd = random.Random(5)
    left = [round(rnd.choice([1, -1]) * rnd.uniform(0, 30), 2) for _ in range(1500)] + [0.0, -0.0, float("nan"), float("inf"), None, 100.0, 100.5, 99.5, 1240.17, 1227.83, 201.0]
    right = [*left[:400], 0.0, None, float("nan"), float("-inf"), 100.0, 100.0, 1e-300, 1234.0, 200.0]
    a = spark.createDataFrame(list(enumerate(left)), "i long, x double")
    b = spark.createDataFrame(list(enumerate(right)), "j long, y double")
    fine = [x for x in left if x is not None and abs(x) < float("inf")]
    want = {j: n for j, y in enumerate(right) if y is not None and abs(y) < float("inf") and (n := sum(abs(x - y) <= 0.005 * abs(y) for x in fine))}
    got = bands.counts(a, b, "x", "y")
    assert {r.j: r.n_near for r in got.collect()} == want
    assert "Join [_a" not in got._jdf.queryExecution().executedPlan().toString()


def test_gate_keeps_the_former_batch(spark):
    name = "g" + uuid.uuid4().hex[:12]
    gate = publish.Gate.at(spark, name, 0.5, publish.share_without("error"), lambda rows: rows.groupBy("event_type").count())
    batch = lambda *kinds: spark.createDataFrame([(k,) for k in kinds], "event_type string")
    gate(batch("error", "error", "view"), 0)
    assert gate.published() is None and not spark.catalog.tableExists(name)
    gate(batch("view", "error"), 1)
    began = spark.table(name)
    gate(batch("error"), 2)
    assert gate.published() == 1 and began.count() == 2
    gate(batch("view"), 3)
    gate(batch("view", "error"), 1)  # runs again, late
    gate(batch("view"), 3)  # runs twice
    gate(batch("x").limit(0), 4)
    assert gate.published() == 3 and [tuple(r) for r in spark.table(name).collect()] == [("view", 1)]
    assert sorted(map(tuple, gate.log().collect())) == [(0, pytest.approx(1 / 3), False), (1, 0.5, True), (2, 0.0, False), (3, 1.0, True), (4, None, False)]
    assert began.count() == 2


def test_gate_over_a_stream(spark, tmp_path):
    name, src = "g" + uuid.uuid4().hex[:12], str(tmp_path / "in")
    gate = publish.Gate.at(spark, name, 0.5, publish.share_without("error"), lambda rows: rows.select("event_type"))
    for kinds in (["view"], ["error"], ["click", "view"]):
        spark.createDataFrame([(k,) for k in kinds], "event_type string").coalesce(1).write.mode("append").parquet(src)
        gate.run(spark.readStream.schema("event_type string").parquet(src), str(tmp_path / "state"))
    assert gate.published() == 2 and spark.table(name).count() == 2 and gate.log().count() == 3


def test_keyed_state_with_expiry(spark, tmp_path):
    src, (out, state) = str(tmp_path / "in"), fresh.folders(spark)

    def feed(*rows):
        at = [(k, d, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)) for k, d, h in rows]
        spark.createDataFrame(at, "key long, digest string, at timestamp").coalesce(1).write.mode("append").parquet(src)
        return fresh.computed(spark.readStream.schema("key long, digest string, at timestamp").parquet(src), 24 * 3600, "1 hour", out, state)

    def seen():
        return sorted((r.key, r.digest, r.reason) for r in fresh.results(spark, out).collect())

    assert feed((1, "a", 0), (1, "a", 1), (2, "b", 0)) == 2
    assert seen() == [(1, "a", "new"), (2, "b", "new")]
    feed((1, "a", 5), (2, "c", 6), (2, "c", 7))  # a restart: unchanged contents are skipped
    assert seen() == [(1, "a", "new"), (2, "b", "new"), (2, "c", "changed")]
    feed((1, "a", 25), (3, "z", 26))  # past the time to live
    assert (1, "a", "expired") in seen() or seen().count((1, "a", "new")) == 2
    assert feed((3, "z", 200), (4, "y", 201)) >= 1
    assert feed((4, "y", 202)) == 2  # the timers of 1 and 2 have gone off, 3 was computed again


def test_keyed_state_of_more_keys_than_shelves(spark, tmp_path):
    """Keys that share a shelf keep their own digests and times; the state is read by shelves, not by keys."""
    rnd, src, (out, state) = random.Random(6), str(tmp_path / "in"), fresh.folders(spark)
    start, want, last = datetime.datetime(2024, 1, 1), [], {}
    for week in range(2):
        rows = sorted((week * 168 + rnd.randrange(168), rnd.choice("ab"), rnd.randrange(2 * fresh.SHELVES)) for _ in range(6000))
        spark.createDataFrame([(k, d, start + datetime.timedelta(hours=h)) for h, d, k in rows], "key long, digest string, at timestamp").coalesce(1).write.mode("append").parquet(src)
        held = fresh.computed(spark.readStream.schema("key long, digest string, at timestamp").parquet(src), 48 * 3600, "1 hour", out, state)
        for h, d, k in rows:
            if k not in last or last[k][0] != d or h - last[k][1] >= 48:
                want.append((k, d, h))
                last[k] = (d, h)
    seen = [(r.key, r.digest, round((r.at - start).total_seconds() / 3600)) for r in fresh.results(spark, out).collect()]
    assert sorted(seen) == sorted(want) and 0 < held <= fresh.SHELVES
