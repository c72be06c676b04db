"""Exact order statistics of groups of any size, in two passes and without gathering a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stretches into which a group's range is cut: a task sorts about one in so many of its rows.
STRETCHES = 4096


def at_places(rows: DataFrame, key: str, value: str, places: dict[str, Column], stretches: int = STRETCHES) -> DataFrame:
    """(key, one column a place): the value that stands at a place, counted from 0, of each group's ascending values.
    places: expressions over n, the number of values. Null values do not count.

    Equal stretches of each group's range are counted; only the stretch that holds a place is sorted, and there equal
    values are one row with a count."""
    own = rows.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v")).filter("_v is not null")
    span = own.groupBy("_k").agg(F.count("*").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    share = F.try_divide(F.col("_v") - F.col("_low"), F.col("_high") - F.col("_low"))
    cut = own.alias("o").join(span.alias("g"), F.expr("o._k <=> g._k")).select("o._k", "_v", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * stretches), F.lit(stretches - 1)).alias("_b"))
    sizes = cut.groupBy("_k", "_b").agg(F.count("*").alias("_m"))
    upto = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_m").over(upto), F.lit(0)))
    asked = span.select("_k", F.inline(F.array(*(F.struct(F.lit(name).alias("_name"), place.cast("bigint").alias("_at")) for name, place in places.items()))))
    where = sizes.alias("s").join(asked.alias("a"), F.expr("s._k <=> a._k") & F.expr("a._at >= s._before and a._at < s._before + s._m")).select("s._k", "s._b", "_name", (F.col("_at") - F.col("_before")).alias("_at"))
    counts = cut.groupBy("_k", "_b", "_v").agg(F.count("*").alias("_c"))
    inside = Window.partitionBy("_k", "_b").orderBy("_v")
    few = counts.alias("c").join(where.select("_k", "_b").distinct().alias("w"), F.expr("c._k <=> w._k and c._b = w._b"), "left_semi")
    few = few.withColumn("_to", F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    found = few.alias("f").join(where.alias("w"), F.expr("f._k <=> w._k and f._b = w._b and w._at < f._to and w._at >= f._to - f._c")).select("f._k", "_name", "_v")
    return found.groupBy(F.col("_k").alias(key)).agg(*(F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in places))


def latency(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, p50, p95): the median, the mean of the middle two of an even number, and the 95th percentile at the nearest
    rank, a half rounded to the even place."""
    n = F.col("n")
    got = at_places(rows, key, value, {"_a": F.floor((n - 1) / 2), "_z": F.ceil((n - 1) / 2), "p95": F.bround(F.lit(0.95) * (n - 1))})
    return got.select(key, ((F.col("_a") + F.col("_z")) / 2).alias("p50"), "p95")


def counts_to(rows: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """(le, n): how many values are at most each bound, in one pass without a join."""
    one = rows.agg(*(F.count_if(F.col(value) <= b).alias(f"n{i}") for i, b in enumerate(bounds)))
    return one.select(F.inline(F.array(*(F.struct(F.lit(float(b)).alias("le"), F.col(f"n{i}").alias("n")) for i, b in enumerate(bounds)))))
