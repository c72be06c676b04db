"""Service-level rules over event tables: burn rates, histogram quantiles, hold durations.

Events are first added up in small time steps, so that windows see a row a step and key, not a row an event. Windows
that reach back a fixed time are dealt by key and stretch of time, so a key with most of the rows is many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _stretches(rows: DataFrame, at: str, seconds: int) -> DataFrame:
    """Each row in its own stretch of `seconds` (_own true) and as what went before in the next: a window that reaches
    back less than a stretch is whole inside (key, _stretch)."""
    own = F.floor(F.col(at) / seconds)
    return rows.withColumn("_stretch", F.explode(F.array(own, own + 1))).withColumn("_own", F.col("_stretch") == own)


def steps(events: DataFrame, key: str, seconds: Column, bad: Column, width: int = 60) -> DataFrame:
    """(key, step, total, bad): events and bad events a key and step of `width` seconds, named by its first second."""
    at = (F.floor(seconds / width) * width).cast("bigint")
    return events.groupBy(key, at.alias("step")).agg(F.count("*").alias("total"), F.sum(bad.cast("int")).alias("bad"))


def burn_rates(per_step: DataFrame, key: str, window: int, objective: float) -> DataFrame:
    """Each step with the share of bad events in the `window` seconds that end with it, over the share that the
    objective allows: 1 uses up the allowance exactly."""
    w = Window.partitionBy(key, "_stretch").orderBy("step").rangeBetween(-window + 1, 0)
    share = F.sum("bad").over(w) / F.sum("total").over(w)
    return _stretches(per_step, "step", window).select(key, "step", F.round(share / (1 - objective), 6).alias("burn"), "_own").filter("_own").drop("_own")


def held(states: DataFrame, key: str, at: str, firing: str, seconds: int) -> DataFrame:
    """(key, since, until): runs of rows that fire without a break and last at least so many seconds."""
    w = Window.partitionBy(key).orderBy(at)
    island = F.sum((~F.col(firing)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = states.withColumn("_run", island).filter(firing).groupBy(key, "_run").agg(F.min(at).alias("since"), F.max(at).alias("until"))
    return runs.filter(F.col("until") - F.col("since") >= seconds).drop("_run")


def inhibited(alerts: DataFrame, sources: DataFrame, on: list[str]) -> DataFrame:
    """The alerts of which no source alert has the same labels; null labels are the same as nothing."""
    return alerts.join(sources.select(*on).distinct(), on, "left_anti").select(*alerts.columns)


def histogram_quantile(counts: DataFrame, key: str, q: float) -> DataFrame:
    """(key, value) from cumulative counts (key, le, n), the last le infinite: linear inside the bucket that holds the
    quantile; the highest finite bound if that is the last one; null for a key without events."""
    w = Window.partitionBy(key).orderBy("le")
    rows = counts.select(key, "le", "n", F.lag("le").over(w).alias("low"), F.coalesce(F.lag("n").over(w), F.lit(0)).alias("before"), (F.max("n").over(Window.partitionBy(key)) * q).alias("rank"))
    hit = F.min_by(F.struct("le", "n", "low", "before", "rank"), F.when((F.col("n") >= F.col("rank")) & (F.col("rank") > 0), F.col("le")))
    found = rows.groupBy(key).agg(hit.alias("b"))
    low = F.coalesce("b.low", F.lit(0.0))
    inside = low + (F.col("b.le") - low) * (F.col("b.rank") - F.col("b.before")) / (F.col("b.n") - F.col("b.before"))
    return found.select(key, F.when(F.col("b.le") == F.lit(float("inf")), F.col("b.low")).otherwise(inside).alias("value"))


def increase(samples: DataFrame, key: str, at: str, value: str, seconds: int) -> DataFrame:
    """(key, at, increase, rate): how much a counter (key, at in seconds, value) has grown in the `seconds` up to each
    sample, by the samples within, and that by the second. A counter that falls has begun anew from 0."""
    in_order = Window.partitionBy(key, "_stretch").orderBy(at)
    rows = _stretches(samples, at, seconds)
    grown = rows.select(key, at, "_stretch", "_own", F.col(value).alias("_v"), F.lag(value).over(in_order).alias("_was"))
    step = F.when(F.col("_was").isNull(), 0.0).when(F.col("_v") >= F.col("_was"), F.col("_v") - F.col("_was")).otherwise(F.col("_v"))
    upto = F.sum("_step").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    run = grown.withColumn("_step", step.cast("double")).withColumn("_upto", upto).withColumn("_now", F.max("_upto").over(Window.partitionBy(key, "_stretch", at)))
    # Each sample once as itself and once at the start of its window: going back in time, the last sample met there is the
    # first of the window, whose own growth was before. No frame slides, so a row costs the same however dense they are.
    nothing = F.lit(None)
    itself = F.struct(F.col(at).alias("_at"), F.col("_upto").alias("_first"), nothing.cast(samples.schema[at].dataType).alias("_of"))
    start = F.struct((F.col(at) - seconds + 1).alias("_at"), nothing.cast("double").alias("_first"), F.col(at).alias("_of"))
    places = F.when(F.col("_own"), F.array(itself, start)).otherwise(F.array(itself))
    back = Window.partitionBy(key, "_stretch").orderBy(F.desc("_at"), F.desc_nulls_last("_first")).rowsBetween(Window.unboundedPreceding, 0)
    met = run.select(key, "_stretch", "_now", F.inline(places)).withColumn("_met", F.last("_first", ignorenulls=True).over(back)).filter("_of is not null")
    total = F.col("_now") - F.col("_met")
    return met.select(key, F.col("_of").alias(at), total.alias("increase"), (total / seconds).alias("rate"))
