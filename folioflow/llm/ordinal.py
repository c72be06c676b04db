"""Quality by ordinal cumulative-link regression: graded ratings share one weight vector and differ by thresholds.

P(grade > k) = sigmoid(w . x - t_k) with t_0 < t_1 < ...; x holds hashed features of the text. From these come the
expected grade and the tail probability of reaching a grade, by which documents are selected.
Features (hashed to 2**18 places): words in lower case, the last three characters of each token, its shape, and how
often a token repeats the one before it; each family is averaged over the text's tokens.

Defined cases: null and empty texts have only the constant feature "empty"; repeated rows are scored alike; without
two different grades the tail probability is 1 and the expected grade the only one known (0 without any); a text of any
length is scored as a whole; equal scores are equal, there is no order to break ties in; no rows give an empty result;
other columns are ignored or kept as asked, under any names.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, linear

#: Labelled documents read for fitting, at most, all grades together.
SAMPLE = 4000
BITS = 18


def token_features(token: str) -> list[int]:
    shape = "U" if token.isupper() and len(token) > 1 else "D" if token[0].isdigit() else "S" if not token[0].isalnum() else "T" if token[0].isupper() else "l"
    return [crc32(x.encode()) & ((1 << BITS) - 1) for x in ("w" + token.lower(), "e" + token[-3:], "s" + shape, "x" + shape + ("" if token[-1].isalnum() else token[-1]))]


def document_features(tokens: list[str]) -> list[int]:
    """Places of features of the whole text: the share of repeated tokens and of different ones, and the length, in steps."""
    n = len(tokens)
    if not n:
        return [crc32(b"empty") & ((1 << BITS) - 1)]
    repeats = sum(map(operator.eq, tokens, tokens[1:])) / n
    distinct = len(set(tokens)) / n
    return [crc32(x.encode()) & ((1 << BITS) - 1) for x in (f"repeats {int(repeats * 10)}", f"distinct {int(distinct * 10)}", f"length {min(n.bit_length(), 12)}")]


@dataclass(frozen=True)
class Model:
    grades: tuple[int, ...]
    weights: np.ndarray
    thresholds: np.ndarray


class Tokens(dict):
    """Token -> the weight of its features. Bounded."""

    def __init__(self, model: Model, limit: int = 500_000):
        super().__init__()
        self.model, self.limit = model, limit

    def __missing__(self, token: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        got = float(sum(self.model.weights[i] for i in token_features(token)))
        if len(token) <= 64:
            self[token] = got
        return got

    def linear(self, text: str) -> float:
        tokens = text.split()
        own = sum(self.model.weights[i] for i in document_features(tokens))
        return float(own + (sum(map(self.__getitem__, tokens)) / len(tokens) if tokens else 0.0))


def tails(model: Model, s: np.ndarray) -> np.ndarray:
    """P(grade > k) for each k below the highest: one row a text."""
    return linear.sigmoid(s[:, None] - model.thresholds[None, :])


def fit(sample: list[tuple[str, int, float]], steps: int = 250, rate: float = 0.08, l2: float = 1e-6) -> Model:
    """Fits (text, grade, weight) rows by the likelihood of the grades."""
    grades = tuple(sorted({y for _, y, _ in sample}))
    zero = np.zeros(1 << BITS)
    if len(grades) < 2:
        return Model(grades or (0,), zero, np.zeros(0))
    k = np.array([grades.index(y) for _, y, _ in sample])
    weight = np.array([w for _, _, w in sample])
    weight = weight / weight.sum()
    memo: dict[str, list[int]] = {}
    rows, cols, vals = [], [], []
    for i, (text, _, _) in enumerate(sample):
        tokens = text.split()
        got = []
        for t in tokens:
            f = memo.get(t)
            if f is None:
                if len(memo) > 200_000:
                    memo.clear()
                f = memo[t] = token_features(t)
            got += f
        u, n = np.unique(np.array(got, np.int64), return_counts=True)
        own = np.array(document_features(tokens))
        rows.append(np.full(len(u) + len(own), i))
        cols.append(np.concatenate([u, own]))
        vals.append(np.concatenate([n / max(1, len(tokens)), np.ones(len(own))]))
    rows, cols, vals = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    used, cols = np.unique(cols, return_inverse=True)
    m = len(grades) - 1

    def thresholds(raw: np.ndarray) -> np.ndarray:
        return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])

    def gradient(x: np.ndarray) -> np.ndarray:
        w, raw = x[:-m], x[-m:]
        t = thresholds(raw)
        s = np.bincount(rows, w[cols] * vals, len(sample))
        above = np.concatenate([np.ones((len(s), 1)), linear.sigmoid(s[:, None] - t), np.zeros((len(s), 1))], axis=1)
        i = np.arange(len(s))
        p = np.maximum(above[i, k] - above[i, k + 1], 1e-9)
        slope = above * (1 - above)
        ds = weight * (slope[i, k] - slope[i, k + 1]) / p
        dt = np.zeros(m + 2)
        np.add.at(dt, k, -weight * slope[i, k] / p)
        np.add.at(dt, k + 1, weight * slope[i, k + 1] / p)
        dt = dt[1:-1]
        draw = np.concatenate([[dt.sum()], np.cumsum(dt[::-1])[::-1][1:] * np.exp(raw[1:])])
        return -np.concatenate([np.bincount(cols, ds[rows] * vals, len(used)) - l2 * w, draw])

    share = np.cumsum(np.bincount(k, weight, m + 1)[::-1])[::-1][1:]
    start = -np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1))
    raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    x = linear.adam(gradient, np.concatenate([np.zeros(len(used)), raw]), steps, rate)
    zero[used] = x[:-m]
    return Model(grades, zero, thresholds(x[-m:]))


def train(docs: DataFrame, labels: DataFrame, grade: str = "quality", bound: int = SAMPLE) -> Model:
    """Fits on a bounded sample of the rated documents outside the held-out fifth."""
    return linear.fitted(docs, labels, grade, bound, fit)


def scored(docs: DataFrame, model: Model, at_least: int | None = None, keep_from: float = 0.5, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, expected_grade, tails (P of each grade above the lowest or a higher one), score (P of grade
    at_least or higher; None: the highest), and keep: whether the score reaches keep_from."""
    spark = docs.sparkSession
    common.ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    chosen = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), common.text_of().alias("_text"))
    schema = chosen.drop("_text").selectExpr("*", "0D expected_grade", "cast(array() as array<double>) tails", "0D score", "false keep").schema
    goal = model.grades[-1] if at_least is None else at_least

    def run(batches):
        own = shared.value
        tokens = Tokens(own)
        for batch in batches:
            s = np.array([tokens.linear(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.float64)
            p = tails(own, s)
            steps = np.diff(np.array(own.grades, np.float64))
            above = [i for i, g in enumerate(own.grades) if g >= goal]
            score = np.zeros(len(s)) if not above else np.ones(len(s)) if above[0] == 0 else p[:, above[0] - 1]
            cols = [pa.array(own.grades[0] + p @ steps), pa.array(list(p), pa.list_(pa.float64())), pa.array(score), pa.array(score >= keep_from)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], schema.names)

    return chosen.mapInArrow(common.lean(run), schema).toDF(*keep, *schema.names[len(keep) :])
