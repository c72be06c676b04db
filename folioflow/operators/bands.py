"""A join of values that are close in proportion, without any other key."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import ship_code


def _different(rows: DataFrame, column: str, name: str) -> DataFrame:
    """(name, n): each finite value and how many rows have it."""
    v = F.col(column).cast("double")
    return rows.select(v.alias(name)).filter((F.abs(v) < float("inf")) & ~F.isnan(v)).groupBy(name).agg(F.count("*").alias("n"))


def _bucket(name: str, tolerance: float) -> Column:
    width = -math.log1p(-tolerance)
    return F.struct(F.signum(name).alias("sign"), F.when(F.col(name) != 0, F.floor(F.ln(F.abs(name)) / width)).otherwise(0).alias("b"))


def _around(name: str, tolerance: float) -> Column:
    """The buckets in which values near to this one may be."""
    own = _bucket(name, tolerance)
    return F.transform(F.array(*(F.lit(i) for i in (-1, 0, 1))), lambda i: F.struct(own["sign"].alias("sign"), (own["b"] + i).alias("b")))


def near(left: DataFrame, right: DataFrame, value: str, other: str, tolerance: float = 0.005) -> DataFrame:
    """The pairs of rows with |value - other| <= tolerance * |other|, columns of left and then of right.

    Values of one sign whose quotient is within the tolerance have logarithms at most -ln(1 - tolerance) apart, so they
    fall into the same or a neighbouring bucket of that width: each right row goes to three buckets, and all meet by hash.
    Zero is near to zero alone. Each different value is joined once, so rows of one value do not multiply before the
    output: left and right rows come back to their values by equality. Null and non-finite values are near to nothing."""
    a = _different(left, value, "_a").select("_a").withColumn("_k", _bucket("_a", tolerance))
    b = _different(right, other, "_b").select("_b").withColumn("_k", F.explode(_around("_b", tolerance)))
    close = a.join(b, "_k").filter(F.abs(F.col("_a") - F.col("_b")) <= tolerance * F.abs("_b")).select("_a", "_b").distinct()
    pairs = left.withColumn("_a", F.col(value).cast("double")).join(close, "_a")
    return pairs.join(right.withColumn("_b", F.col(other).cast("double")), "_b").drop("_a", "_b")


def _counted(xs: pa.Table, ys: pa.Table, tolerance: float) -> pa.Table:
    """For each value of ys (y) how many rows of xs (x, n) are near. The difference to y grows with x on either side, so
    the near ones are one run of the sorted values; its ends are looked up and then set right by the condition itself."""
    order = np.argsort(xs["x"].to_numpy())
    x, n, y = xs["x"].to_numpy()[order], xs["n"].to_numpy()[order], ys["y"].to_numpy()
    reach = tolerance * np.abs(y)
    padded = np.concatenate([[-np.inf], x, [np.inf]])  # x[i] is padded[i + 1]; the ends are near to nothing
    first, last = np.searchsorted(x, y - reach), np.searchsorted(x, y + reach, "right")
    while True:  # at most the few values within an error of rounding
        down, up = np.abs(padded[first] - y) <= reach, (first < last) & ~(np.abs(padded[first + 1] - y) <= reach)
        wider, less = np.abs(padded[last + 1] - y) <= reach, (last > first) & ~(np.abs(padded[last] - y) <= reach)
        if not (down | up | wider | less).any():
            break
        first, last = first - down + up, last + wider - less
        last = np.maximum(first, last)
    upto = np.concatenate([[0], np.cumsum(n)])
    return pa.table({"_y": pa.array(y, pa.float64()), "n": pa.array(upto[last] - upto[first], pa.int64())})


def counts(left: DataFrame, right: DataFrame, value: str, other: str, tolerance: float = 0.005) -> DataFrame:
    """Rows of right that have rows of left near them as in near(), with n_near, their number. No pair is made: the
    different values of a bucket are sorted, and what is near to one of them is a run, counted by its ends."""
    ship_code(left.sparkSession)
    a = _different(left, value, "x").withColumn("_k", _bucket("x", tolerance)).select("_k.*", "x", "n")
    b = _different(right, other, "y").withColumn("_k", F.explode(_around("y", tolerance))).select("_k.*", "y")
    found = a.groupBy("sign", "b").cogroup(b.groupBy("sign", "b")).applyInArrow(lambda xs, ys: _counted(xs, ys, tolerance), "_y double, n bigint")
    found = found.groupBy("_y").agg(F.sum("n").alias("n_near")).filter("n_near > 0")
    return right.withColumn("_y", F.col(other).cast("double")).join(found, "_y").drop("_y")
