"""Work that sorts lines of orders is cut into tasks whose number follows the number of lines."""

from pyspark.sql import functions as F

from folioflow.operators import intervals, resolver
from folioflow.plans import facts, fixtures
from folioflow.sources import tables


def test_observations_follow_the_lines(spark, sf, monkeypatch):
    monkeypatch.setattr(tables, "LINES", 400)
    n = -(-tables.table(spark, sf, "lineitem").count() // 400)
    assert n > 8 and facts.observations(spark, sf).rdd.getNumPartitions() == n
    few = resolver.candidates(facts.observations(spark, sf), facts.specs(spark))
    assert few.select(F.spark_partition_id().alias("p")).distinct().count() > 8


def test_spans_are_dealt_once_and_follow_the_lines(spark, sf, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES", 400)
    spans = fixtures.values(spark, sf, fixtures.SPANS)
    assert spans.rdd.getNumPartitions() == -(-tables.table(spark, sf, "lineitem").count() // 400)
    got = intervals.split_at(spark.range(5).selectExpr("id as doc", "0 as start", "50 as end"), spark.range(5).selectExpr("id as doc", "10 as start", "20 as end", "'r' as name"), "doc", 12)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert got.rdd.getNumPartitions() == 12
    assert sorted(map(tuple, got.filter("doc = 3").collect())) == [(3, 0, 10, None), (3, 10, 20, "r"), (3, 20, 50, None)]
