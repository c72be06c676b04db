"""A read-through cache on Parquet: what was computed for a digest is kept until it expires."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import scratch


def read_through(rows: DataFrame, key: str, path: str, compute: Callable[[DataFrame], DataFrame], now: float, seconds: float) -> DataFrame:
    """Rows with hit and what compute (a function of rows, keeping key) adds for the rows whose key is not cached.

    Each new key is computed once and appended with the time at which it expires; of entries of a key the one that
    lasts longest counts. A cache that is not there computes everything. Rows without a key are computed each."""
    spark = rows.sparkSession
    try:
        held = spark.read.parquet(path).filter(F.col("_until") > now)
        held = held.groupBy(key).agg(F.max_by(F.struct(*(c for c in held.columns if c not in (key, "_until"))), "_until").alias("_v"))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        held = None
    new = rows if held is None else rows.join(held.select(key), key, "left_anti")
    fresh = scratch(spark, "computed")
    made = compute(new.filter(F.col(key).isNotNull()).dropDuplicates([key]))
    added = [c for c in made.columns if c not in rows.columns]
    made.select(key, *added).write.parquet(fresh)
    stored = spark.read.schema(made.select(key, *added).schema).parquet(fresh).select(key, F.struct(*added).alias("_v"))
    known = stored.withColumn("hit", F.lit(False))
    if held is not None:
        before = scratch(spark, "held")  # what was held when the misses were told, whatever is appended now
        held.write.parquet(before)
        known = known.unionByName(spark.read.schema(held.schema).parquet(before).withColumn("hit", F.lit(True)))
    stored.select(key, "_v.*", F.lit(float(now + seconds)).alias("_until")).write.mode("append").parquet(path)
    got = rows.filter(F.col(key).isNotNull()).join(known, key).select(*rows.columns, "hit", *(F.col("_v")[c].alias(c) for c in added))
    bare = compute(rows.filter(F.col(key).isNull())).withColumn("hit", F.lit(False))
    return got.unionByName(bare.select(*rows.columns, "hit", *added))


def hit_rate(looked_up: DataFrame) -> DataFrame:
    """(lookups, hits, hit_rate); no look-ups have the rate 0."""
    one = looked_up.agg(F.count("*").alias("lookups"), F.count_if("hit").alias("hits"))
    return one.withColumn("hit_rate", F.coalesce(F.try_divide("hits", "lookups"), F.lit(0.0)))
