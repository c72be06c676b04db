"""Bounded training samples and the small optimiser that the classifiers share."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Code points of a text that may be fitted: this and the number of rows bound what one task holds.
LONGEST = 1 << 17


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> tuple[DataFrame | None, dict[int, int]]:
    """At most `bound` labelled texts, as a table (text, y, weight), and the label counts of all.

    Rows whose crc32(doc_id as text) mod 5 is 0 are never read as labels. Each label value gets an equal share of the
    bound; within it the ids with the smallest hashes are taken (ties: the smallest id), and weights restore the shares
    that all labelled rows have. Null labels and ids are left out; of several labels of an id the largest counts; of
    several texts of an id the one with the smallest hash; texts of more than LONGEST code points are not fitted."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna().filter(~common.held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) > 64:
        raise ValueError("more than 64 different grades")
    if not counts:
        return None, {}
    share = max(1, bound // len(counts))
    chosen = None
    for y in sorted(counts):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(share)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text")).filter(F.char_length("text") <= LONGEST)
    rows = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    total = F.coalesce(*(F.when(F.col("y") == y, F.lit(float(n))) for y, n in counts.items()))
    return rows.select("text", "y", total.alias("total")), counts


def _weighted(rows: list[tuple[str, int, float]]) -> list[tuple[str, int, float]]:
    got = Counter(y for _, y, _ in rows)
    return sorted((text, y, total / got[y]) for text, y, total in rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> tuple[list[tuple[str, int, float]], dict[int, int]]:
    """The rows of labelled_rows on the driver, as (text, label, weight)."""
    rows, counts = labelled_rows(docs, labels, label, bound)
    return _weighted([tuple(r) for r in rows.collect()] if rows is not None else []), counts


def fitted(docs: DataFrame, labels: DataFrame, label: str, bound: int, fit: Callable):
    """The model that `fit` makes of the bounded sample. One task of an executor holds the sample and fits; the driver
    gets the model alone."""
    common.ship_code(docs.sparkSession)
    rows, _ = labelled_rows(docs, labels, label, bound)
    if rows is None:
        return fit([])

    def run(batches):
        got = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(_weighted(got)))], pa.binary())], ["model"])

    found = rows.repartition(1).mapInArrow(common.lean(run), "model binary").collect()
    return pickle.loads(bytes(found[0][0])) if found else fit([])


def adam(gradient, x: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Minimises by full gradients; gradient(x) gives the gradient at x."""
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        g = gradient(x)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        x = x - rate * (1 - 0.5 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
