"""What a task of a vector search gives on at once does not grow with the queries of a batch or with the cells."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.operators import vector_index

CELLS, QUERIES, WIDTH, N = 500, 2000, 64, 400


@pytest.fixture
def index():
    centres = np.random.default_rng(5).normal(size=(CELLS, WIDTH))
    return vector_index.VectorIndex("", centres, CELLS, "array<double>", {c: (c // 7, 1) for c in range(CELLS)} | {3: (90, 4)})


@pytest.fixture
def batch():
    v = np.random.default_rng(6).normal(size=(QUERIES, WIDTH))
    return v, pa.RecordBatch.from_arrays([pa.array(np.arange(QUERIES)), pa.array(list(v))], ["query_id", "query"])


def own(spark, monkeypatch, make):
    """The function that a task runs."""
    rows, got = spark.createDataFrame([], "query_id long, query array<double>"), []
    with monkeypatch.context() as m:
        m.setattr(type(rows), "mapInArrow", lambda self, run, schema: got.append(run) or self.select(F.lit(0).alias("cell")))
        make(rows)
    return got[0]


@pytest.mark.parametrize("step", ["probes", "asked"])
def test_batches_are_bounded_and_whole(spark, monkeypatch, index, batch, step):
    v, whole = batch
    made = list(own(spark, monkeypatch, lambda rows: getattr(index, step)(rows, N))(iter([whole])))
    assert max(b.nbytes for b in made) < 8 << 20
    near = np.argsort(-np.round(v @ index.centres.T, 9), axis=1, kind="stable")[:, :N]
    table = pa.Table.from_batches(made)
    if step == "probes":
        assert table["query_id"].to_pylist() == np.repeat(np.arange(QUERIES), N).tolist() and table["cell"].to_pylist() == near.reshape(-1).tolist()
        assert table["place"].to_pylist() == list(range(N)) * QUERIES
        return
    got = {}
    for q, block, cells in zip(*(table[c].to_pylist() for c in ("query_id", "block", "cells")), strict=True):
        got[q, block] = cells
    for q in range(0, QUERIES, 97):
        want = {}
        for c in sorted(near[q]):
            a, p = index.shelves[int(c)]
            for block in range(a, a + p):
                want.setdefault(block, []).append(int(c))
        assert {b: c for (i, b), c in got.items() if i == q} == want


def test_a_task_names_a_cell_once(spark, monkeypatch, index, batch):
    v, whole = batch
    made = list(own(spark, monkeypatch, lambda rows: index.cells(rows, 2))(iter([whole.slice(0, 300), whole.slice(300)])))
    near = np.argsort(-np.round(v @ index.centres.T, 9), axis=1, kind="stable")[:, :2]
    assert [b.column(0).to_pylist() for b in made] == [np.unique(near).tolist()]


def test_rows_are_dealt_to_their_nearest_centre_in_slices(index, batch):
    assert vector_index._closest(batch[0], index.centres).tolist() == (batch[0] @ index.centres.T).argmax(axis=1).tolist()
    assert vector_index._closest(batch[0][:0], index.centres).tolist() == []
