"""Interval and as-of operators by sorting, without range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def containing(points: DataFrame, regions: DataFrame, key: str) -> DataFrame:
    """Left join of points (key, pos) to the region (key, start, end, name) that holds them: start <= pos < end.

    Regions of a key do not overlap. Both sides are sorted once by key and place; the last region opened before a point
    is carried to it."""
    events = regions.select(key, F.col("start").alias("at"), F.lit(0).alias("kind"), F.struct("start", "end", "name").alias("region"), F.lit(None).cast("bigint").alias("pos"))
    events = events.unionByName(points.select(key, F.col("pos").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(events.schema["region"].dataType).alias("region"), F.col("pos").cast("bigint").alias("pos")))
    w = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    held = events.withColumn("open", F.last("region", ignorenulls=True).over(w)).filter("kind = 1")
    return held.select(key, "pos", F.when(F.col("pos") < F.col("open.end"), F.col("open.name")).alias("name"))


def running_records(rows: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Rows whose value exceeds all before it in its group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_m", F.max(value).over(w)).filter(F.col("_m").isNull() | (F.col(value) > F.col("_m"))).drop("_m")


def running_total(rows: DataFrame, by: str, order: str, value: str, width: int, to: str = "total") -> DataFrame:
    """Rows with the sum of the values of their key up to and with their own, equal places together. Stretches of `width`
    of the order are added up first, so a long key is many tasks; one task sees a row a stretch of a key."""
    placed = rows.withColumn("_stretch", F.floor(F.col(order) / width))
    sums = placed.groupBy(by, "_stretch").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col(by).alias("_by"), F.col("_stretch").alias("_s"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    own = placed.withColumn("_inside", F.sum(value).over(Window.partitionBy(by, "_stretch").orderBy(order)))
    both = own.join(carried, own[by].eqNullSafe(F.col("_by")) & F.col("_stretch").eqNullSafe(F.col("_s")))
    return both.select(*(own[c] for c in rows.columns), (F.col("_carried") + F.coalesce("_inside", F.lit(0))).alias(to))


def sessions(events: DataFrame, user: str, seconds: str, gap: int) -> DataFrame:
    """(user, session, n, first, last): runs of events with gaps of at most `gap` seconds."""
    w = Window.partitionBy(user).orderBy(seconds, "event_id")
    new = F.when(F.col(seconds) - F.lag(seconds).over(w) <= gap, 0).otherwise(1)
    marked = events.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(user, "session").agg(F.count("*").alias("n"), F.min(seconds).alias("first_s"), F.max(seconds).alias("last_s"))


def split_at(spans: DataFrame, regions: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Cuts spans (key, start, end) at all edges of regions (key, start, end, name) inside them: (key, start, end, name),
    name null outside all regions. Neither the spans of a key nor its regions overlap; all edges are dealt by key once, to
    `tasks` tasks if given, and sorted there."""

    def edged(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        return rows.select(key, F.inline(F.array(F.struct(F.col("start").alias("at"), F.struct(*columns).alias(name)), F.struct(F.col("end").alias("at"), F.lit(None).alias(name)))))

    edges = edged(spans, "span", "start", "end").unionByName(edged(regions, "region", "start", "end", "name"), allowMissingColumns=True)
    edges = edges.repartition(*([] if tasks is None else [tasks]), key)
    edges = edges.groupBy(key, "at").agg(F.max("span").alias("span"), F.max("region").alias("region"))
    w = Window.partitionBy(key).orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cut = edges.select(key, F.col("at").alias("start"), F.lead("at").over(w).alias("end"), F.last("span", True).over(upto).alias("s"), F.last("region", True).over(upto).alias("r"))
    return cut.filter("start < s.end").select(key, "start", "end", F.when(F.col("start") < F.col("r.end"), F.col("r.name")).alias("name"))


def counted_before(points: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Points (key, pos) with n, the number of marks (key, pos) of their key at or before them."""
    both = marks.select(key, "pos", F.lit(1).alias("_mark")).unionByName(points.select(key, "pos", F.lit(0).alias("_mark")))
    w = Window.partitionBy(key).orderBy("pos", F.desc("_mark")).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("n", F.sum("_mark").over(w)).filter("_mark = 0").drop("_mark")
