"""Mergeable aggregates: a row a day and group with sketches, merged for any range of days.

Distinct counts are HyperLogLog sketches, quantiles KLL sketches; both merge without loss beyond their own error, so a
range of any length reads one narrow row a day. The error of a distinct count has a standard deviation of about
1.04 / sqrt(2 ** lg_k), that of a quantile's rank is about 1.7 % for k = 200 (99 % of the time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K, KLL_K = 12, 200


def daily(rows: DataFrame, at: str, group: str, counted: str, measured: str, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """(day, group, n, total, distinct, spread): what is kept of each day. Null values are in n alone."""
    value = F.col(measured).cast("double")
    return rows.groupBy(F.to_date(at).alias("day"), F.col(group).alias("group")).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.hll_sketch_agg(counted, lg_k).alias("distinct"), F.kll_sketch_agg_double(value, k).alias("spread")
    )


def ranges(kept: DataFrame, asked: DataFrame, quantiles: list[float]) -> DataFrame:
    """For each asked range (name, start, end; both days included) and group: n, total, n_distinct and the quantiles.

    A day joins the ranges that hold it by its date, so ranges may overlap; every range is answered from the same rows."""
    days = asked.withColumn("day", F.explode(F.sequence("start", "end"))).select("name", "day")
    merged = kept.join(days, "day").groupBy("name", "group").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"), F.kll_merge_agg_double("spread").alias("s")
    )
    points = [F.kll_sketch_get_quantile_double("s", F.lit(float(q))).alias(f"p{round(100 * q)}") for q in quantiles]
    return merged.select("name", "group", "n", "total", "n_distinct", *points)
