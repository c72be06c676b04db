"""Rate limiting and circuit breaking as folds over ordered events of a key."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import scratch

#: Calls that a block has, about.
BLOCK = 4096


def token_bucket_waits(events: DataFrame, rate: float, block: int = BLOCK) -> DataFrame:
    """(key, t, n) -> the seconds each call has to wait: a bucket of `rate` tokens, refilled at `rate` a second; a call
    may take tokens that are not there yet and waits for them. Calls at one time are taken by ascending n.

    Calls are dealt by order into blocks. Of tokens x a block makes min(most, x + gain), so the level that each block
    of a key starts from follows from one row a block, and no task has to hold a key."""
    spark = events.sparkSession
    calls = events.select(F.col("key").cast("string").alias("key"), F.col("t").cast("double").alias("t"), F.col("n").cast("double").alias("n"))
    order = [F.col(c).asc_nulls_last() for c in ("key", "t", "n")] + [F.col("_tie")]
    parts = max(1, -(-calls.count() // block))
    dealt = calls.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order).withColumn("block", F.spark_partition_id())
    path = scratch(spark, "calls")  # written once, so that the blocks of both passes are the same
    dealt.select("key", "t", "n", "block").write.parquet(path)
    rows = spark.read.schema("key string, t double, n double, block int").parquet(path)

    def effect(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "n"])
        most, gain, last = math.inf, 0.0, None
        for t, n in zip(pdf["t"], pdf["n"], strict=True):
            if last is not None:
                most, gain = min(rate, most + (t - last) * rate), gain + (t - last) * rate
            last = t
            most, gain = most - n, gain - n
        return pdf.head(1)[["key", "block"]].assign(first=pdf["t"].iloc[0], last=last, most=most, gain=gain)

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        level, last, levels = rate, None, []
        for t, end, most, gain in zip(pdf["first"], pdf["last"], pdf["most"], pdf["gain"], strict=True):
            if last is not None:
                level = min(rate, level + (t - last) * rate)
            levels.append(level)
            level, last = min(most, level + gain), end
        return pdf.assign(level=levels)[["key", "block", "level"]]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "n"])
        level, last, waits = pdf["level"].iloc[0], None, []
        for t, n in zip(pdf["t"], pdf["n"], strict=True):
            if last is not None:
                level = min(rate, level + (t - last) * rate)
            last = t
            level -= n
            waits.append(max(0.0, -level / rate))
        return pdf.assign(wait=waits)[["key", "t", "wait"]]

    effects = rows.groupBy("key", "block").applyInPandas(effect, "key string, block int, first double, last double, most double, gain double")
    starts = effects.groupBy("key").applyInPandas(carry, "key string, block int, level double").withColumnsRenamed({"key": "_key", "block": "_block"})
    held = rows.join(starts, F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")))
    return held.select("key", "t", "n", "block", "level").groupBy("key", "block").applyInPandas(fold, "key string, t double, wait double")


def breaker_states(events: DataFrame, failures: int, cooldown: float) -> DataFrame:
    """(key, t, ok) -> the state before each call (closed, open, half_open): open after so many failures in a row, half
    open after the cooldown; a success closes, a failure when half open opens again."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        state, bad, since, out = "closed", 0, 0.0, []
        for t, ok in zip(pdf["t"], pdf["ok"], strict=True):
            if state == "open" and t - since >= cooldown:
                state = "half_open"
            out.append(state)
            if state == "open":
                continue
            if ok:
                state, bad = "closed", 0
            else:
                bad += 1
                if state == "half_open" or bad >= failures:
                    state, since, bad = "open", t, 0
        return pdf.assign(state=out)[["key", "t", "state"]]

    return events.groupBy("key").applyInPandas(fold, "key string, t double, state string")
