"""The store and declared layouts: versions, what they share, refusals, and plans without an exchange."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from folioflow.sources import store as S

SCHEMA = StructType([StructField("id", LongType()), StructField("group", StringType()), StructField("company", StringType()), StructField("v", ArrayType(FloatType())), StructField("place", StringType())])


@pytest.fixture
def store(spark):
    made = S.Store(spark, "s" + uuid.uuid4().hex[:12], "id", "place", SCHEMA, ("company", "v"), (F.col("group").isNotNull(),))
    return made.create()


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_rewrites_only_touched_partitions(spark, store):
    assert store.create().version() == 0 and store.read().count() == 0
    store.upsert(rows(spark, (1, "a", "x", [1.0], "p/1"), (2, "a", "y", None, "p'2"), (3, "b", "z", [3.0], None)))
    before, first = store.locations(), store.read()
    assert set(before) == {"p/1", "p'2", None}
    assert store.upsert(rows(spark, (2, "c", None, [2.0], "p'2"), (4, "d", "w", None, "p4"))) == ["p'2", "p4"]
    after = store.locations()
    assert after["p/1"] == before["p/1"] and after[None] == before[None] and after["p'2"] != before["p'2"]
    assert held(store.read()) == held(rows(spark, (1, "a", "x", [1.0], "p/1"), (2, "c", "y", [2.0], "p'2"), (3, "b", "z", [3.0], None), (4, "d", "w", None, "p4")))
    assert first.filter("id = 2").first().company == "y" and first.count() == 3  # a reader keeps its version
    assert f"PartitionFilters: [isnotnull(place" in store.read().filter("place = 'p4'")._jdf.queryExecution().toString()


def test_a_key_that_moves_leaves_its_old_partition(spark, store):
    store.upsert(rows(spark, (1, "a", "x", [1.0], "p1"), (2, "a", "x", [1.0], "p1")))
    store.upsert(rows(spark, (1, "a", None, None, "p2")))
    assert held(store.read()) == held(rows(spark, (1, "a", "x", [1.0], "p2"), (2, "a", "x", [1.0], "p1")))
    store.upsert(rows(spark, (2, "a", None, None, "p2")))
    assert set(store.locations()) == {"p2"}


def test_update_delete_and_prune(spark, store):
    store.upsert(rows(spark, (1, "a", "x", None, "p1"), (2, "a", "x", None, "p1"), (3, "b", "x", None, "p2"), (4, "c", "x", None, "p3")))
    fresh = spark.createDataFrame([(1, [9.0]), (3, None), (77, [1.0])], "id long, v array<float>")
    assert store.update(fresh, ["v"]) == ["p1", "p2"]
    assert [tuple(r) for r in store.read().filter("v is not null").select("id", "v").collect()] == [(1, [9.0])]
    kept = spark.createDataFrame([(1, "a"), (50, "b")], "id long, group string")
    assert store.prune(kept, "group") == ["p1", "p2"]
    assert sorted(r.id for r in store.read().collect()) == [1, 4]
    assert store.prune(kept.limit(0), "group") == [] and store.read().count() == 2
    store.delete(store.read())
    assert store.read().count() == 0


def test_failed_writes_leave_the_old_version(spark, store):
    store.upsert(rows(spark, (1, "a", "x", None, "p1")))
    now, seen = store.version(), held(store.read())
    with pytest.raises(S.RepeatedKey):
        store.upsert(rows(spark, (2, "a", "x", None, "p1"), (2, "b", "x", None, "p2")))
    with pytest.raises(S.RepeatedKey):
        store.upsert(rows(spark, (None, "a", "x", None, "p1")))
    with pytest.raises(S.BrokenRule):
        store.upsert(rows(spark, (2, None, "x", None, "p1")))
    broken = rows(spark, (2, "a", "x", None, "p1")).withColumn("company", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.upsert(broken)
    assert store.version() == now and held(store.read()) == seen


def test_vacuum_drops_what_no_version_names(spark, store):
    for i in range(3):
        store.upsert(rows(spark, (1, "a", str(i), None, "p1"), *([(2, "b", "x", None, "p2")] if not i else [])))
    place = store.locations()
    gone = store.vacuum()
    assert len(gone) == 2 and not set(gone) & set(place.values())
    assert [r.company for r in store.read().orderBy("id").collect()] == ["2", "x"] and store.locations() == place


def test_declared_layout(spark):
    left, right = ("t" + uuid.uuid4().hex[:12] for _ in range(2))
    schema = StructType([StructField("k", LongType()), StructField("x", StringType())])
    for name in (left, right):
        assert S.declare(spark, name, schema, bucket=["k"], buckets=4, sort=["k"])
        assert not S.declare(spark, name, schema, bucket=["k"], buckets=4, sort=["k"])
        S.load(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("x")), name, ["k"], 4)
    with pytest.raises(ValueError):
        S.declare(spark, left, schema)
    for bad in ([(200, "a"), (200, "b")], [(5, "a")], [(None, "a")]):
        with pytest.raises(S.RepeatedKey):
            S.load(spark.createDataFrame(bad, schema), left, ["k"])
    joined = spark.table(left).hint("merge").join(spark.table(right), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 100
