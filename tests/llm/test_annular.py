"""Codes against comparing every entry in Python integers."""

import hashlib
import math
import random

import numpy as np

from folioflow.llm import annular

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n int"


def plain(rows, parts=4, entries=256, rounds=4):
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    step = len(rows[0][1]) // parts
    xs = [[[math.floor(1024 * float(np.float32(x))) for x in r[1][p * step : (p + 1) * step]] for p in range(parts)] for r in rows]
    books = [[xs[i][p] for i in range(min(entries, len(xs)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, k, strict=True)), i) for i, k in enumerate(book))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            own = {}
            for x in xs:
                own.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for i, members in own.items():
                new[p][i] = [sum(c) // len(members) for c in zip(*members, strict=True)]
        books = new
    digest = hashlib.sha256(",".join(str(c) for b in books for k in b for c in k).encode()).hexdigest()
    out = []
    for r, x in zip(rows, xs, strict=True):
        found = [nearest(x[p], books[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    totals = {}
    for r in out:
        totals[r[1]] = totals.get(r[1], 0) + r[3]
    return sorted(((*r, totals[r[1]]) for r in out), key=str), digest


def got(spark, rows, **kinds):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    books = annular.trained(df, **kinds)
    found = annular.with_label_errors(annular.coded(df, books))
    return sorted((tuple(r[c] for c in ("vec_id", "label", "code", "error", "label_error")) for r in found.collect()), key=str), books


def test_random_vectors(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(16)], rnd.choice([None, 1, 2])) for i in range(500)]
    rows += [(None, rows[3][1], 1), (9, None, 1), (10, [None] + [0.0] * 15, 2), (11, [math.nan] * 16, 2), (12, [math.inf] + [0.0] * 15, 2), (13, [1.0] * 8, 2), (14, [], 2)]
    rows += [rows[20], (20, rows[21][1], 1), (700, [0.0] * 16, None), (701, [-0.0001] * 16, None)]
    want, digest = plain(rows)
    found, books = got(spark, rows)
    assert found == want and annular.digest(books) == digest


def test_ties_and_few_rows(spark):
    rows = [(i, [float(i % 3), 0.0, 0.0, 0.0], None) for i in range(7)]
    want, digest = plain(rows)
    found, books = got(spark, rows)
    assert found == want and annular.digest(books) == digest and books.shape == (4, 7, 1)


def test_huge_components_are_held(spark):
    found, _ = got(spark, [(1, [3e38, 0.0, 0.0, -3e38], 1), (2, [0.0] * 4, 1)])
    assert [r[3] for r in found] == [0, 0]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert annular.trained(df) is None and annular.coded(df, None).collect() == []


def test_annulus_leaves_most_entries_out():
    rng = np.random.default_rng(1)
    book = annular.Book(rng.integers(-300, 300, (256, 16)) * rng.integers(1, 6, (256, 1)))
    x = book.entries[rng.integers(0, 256, 3000)] + rng.integers(-20, 20, (3000, 16))
    index, d, pairs = book.nearest(x)
    order = np.argsort(book.by_norm)
    every = ((x[:, None, :] - book.entries[order][None]) ** 2).sum(axis=2)
    assert (d == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()
    assert pairs < 0.5 * every.size
