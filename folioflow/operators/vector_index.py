"""An inverted-list index over vectors: trained centroids, one list a centroid, exact scores inside the probed lists.

The lists are a table partitioned by cell, so a search reads only the folders of the cells that its queries probe. Every
vector is in exactly one list; null vectors and those without a length are in cell -1, which no query probes. Centroids
are fitted on a bounded sample (SAMPLE rows, those with the smallest hash of their id); all else covers all rows.

Cells are dealt to shelves of about ROW_BLOCK rows: small cells share one, a large cell has several. A search compares
the rows of a shelf with blocks of the queries that probe any of its cells, each pair in one task of bounded size; a query
goes to a shelf once, however many of its cells it probes, and takes its own k best of those. With all cells probed the
result is that of the exact scan."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import scratch, ship_code
from .retrieval import nearest

#: Vectors read for fitting; rows a centroid is worth; bounds of the number of cells.
SAMPLE, ROWS_A_CELL, CELLS = 20_000, 64, (1, 4096)
ROUNDS = 10
#: Rows of a shelf, and queries that probe it, in one task.
ROW_BLOCK, QUERY_BLOCK = 20_000, 2_000
#: Vectors that are compared with all centres at once (8 MB with CELLS of them), and rows with a query that are given on at once.
SLICE, GIVEN = 256, 8_192


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow column without nulls, as doubles."""
    width = len(column[0]) if len(column) else 0
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def _usable(vector: str) -> Column:
    return F.coalesce(F.col(vector).isNotNull() & F.exists(vector, lambda x: x != 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)), F.lit(False))


def _slices(batches: Iterator[pa.RecordBatch], each: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, a few at a time: what is made of a row grows with the number of cells."""
    for batch in batches:
        yield from (batch.slice(i, each) for i in range(0, len(batch), each))


def _closest(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the centre nearest to each row."""
    return np.concatenate([np.zeros(0, np.int64), *((v[i : i + SLICE] @ centres.T).argmax(axis=1) for i in range(0, len(v), SLICE))])


def _order(v: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, the nearest first."""
    return np.argsort(-np.round(v @ centres.T, 9), axis=1, kind="stable")[:, :n].astype(np.int32)


def fitted(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids on the unit sphere: rounds of assignment and means from spread-out first rows."""
    v = _unit(vectors)
    centres = v[:: max(1, len(v) // max(1, cells))][:cells].copy()
    for _ in range(rounds):
        nearest = _closest(v, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, v)
        held = np.linalg.norm(sums, axis=1) > 1e-12
        centres[held] = _unit(sums[held])
    return centres


@dataclass(frozen=True)
class VectorIndex:
    """path: the lists (vec_id, embedding, block, cell), partitioned by cell; centres: one row a cell; shelves: first
    block and number of blocks of each cell that has rows."""

    path: str
    centres: np.ndarray
    rows: int
    kind: str
    shelves: dict[int, tuple[int, int]]

    def lists(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"vec_id bigint, embedding {self.kind}, block int, cell int").parquet(self.path)

    def probes(self, queries: DataFrame, n: int) -> DataFrame:
        """(query_id, cell, place) for the n nearest cells of each query (query_id, query), the nearest at place 0."""
        centres, n = self.centres, min(n, len(self.centres))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                near, places = _order(_matrix(batch.column(1)), centres, n).reshape(-1), np.tile(np.arange(n, dtype=np.int32), len(batch))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), n))), pa.array(near), pa.array(places)], ["query_id", "cell", "place"])

        return self._queries(queries).mapInArrow(run, "query_id bigint, cell int, place int")

    def cells(self, queries: DataFrame, n: int) -> DataFrame:
        """(cell): those among the n nearest of any query. A task gives each cell once, however many of its queries name it."""
        centres = self.centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            named = np.zeros(len(centres), bool)
            for batch in _slices(batches):
                named[_order(_matrix(batch.column(1)), centres, n)] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(named).astype(np.int32))], ["cell"])

        return self._queries(queries).mapInArrow(run, "cell int").distinct()

    def _queries(self, queries: DataFrame) -> DataFrame:
        ship_code(queries.sparkSession)
        return queries.filter(_usable("query")).select(F.col("query_id").cast("bigint").alias("query_id"), F.col("query").cast("array<double>").alias("query"))

    def asked(self, queries: DataFrame, n: int) -> DataFrame:
        """(query_id, query, block, cells): each query once for every shelf with cells among its n nearest, and these."""
        centres, shelves = self.centres, self.shelves
        first = np.array([shelves.get(c, (-1, 0))[0] for c in range(len(centres))])
        more = [(c, range(a + 1, a + p)) for c, (a, p) in shelves.items() if c >= 0 and p > 1]
        each = max(1, min(SLICE, GIVEN // max(1, max((a + p for a, p in shelves.values()), default=1))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches, each):
                near = _order(_matrix(batch.column(1)), centres, n)
                rows = np.repeat(np.arange(len(batch)), near.shape[1])
                cells = near.reshape(-1)
                extra = [(np.repeat(rows[cells == c], len(at)), np.full((cells == c).sum() * len(at), c, np.int32), np.tile(np.array(at), (cells == c).sum())) for c, at in more]
                rows, cells, blocks = (np.concatenate(x) for x in zip((rows, cells, first[cells]), *extra, strict=True))
                order = np.lexsort((cells, blocks, rows))
                rows, cells, blocks = (x[order][blocks[order] >= 0] for x in (rows, cells, blocks))
                edges = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
                at = pa.array(rows[edges])
                listed = pa.ListArray.from_arrays(np.append(edges, len(cells)).astype(np.int32), pa.array(cells, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(blocks[edges], pa.int32()), listed], ["query_id", "query", "block", "cells"])

        return self._queries(queries).mapInArrow(run, "query_id bigint, query array<double>, block int, cells array<int>")


def build(rows: DataFrame, cells: int | None = None, path: str | None = None) -> VectorIndex:
    """Indexes all rows (vec_id, embedding); writes at once. cells: by default a centroid for ROWS_A_CELL rows."""
    spark = rows.sparkSession
    ship_code(spark)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    n = rows.count()
    sample = rows.filter(_usable("embedding")).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select(F.col("embedding").cast("array<double>")).collect()
    wanted = cells or min(CELLS[1], max(CELLS[0], n // ROWS_A_CELL, round(n**0.5) if n < 4096 else 0))
    centres = fitted(np.array([r[0] for r in sample]), min(wanted, len(sample))) if sample else np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.full(len(batch), -1, np.int32)
            held = np.flatnonzero(np.asarray(batch.column(2)))
            if len(held):
                cell[held] = _closest(_matrix(batch.column(1).take(pa.array(held))), centres)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], ["vec_id", "embedding", "cell"])

    kind = rows.schema["embedding"].dataType.simpleString()
    placed = rows.select("vec_id", "embedding", _usable("embedding").alias("held")).mapInArrow(run, f"vec_id bigint, embedding {kind}, cell int")
    path = path or scratch(spark, "vectors")
    unsorted = scratch(spark, "placed")
    placed.write.parquet(unsorted)
    placed = spark.read.schema(placed.schema).parquet(unsorted)
    sizes = sorted((r[0], r[1]) for r in placed.groupBy("cell").count().collect())  # at most CELLS and one numbers
    shelves = shelved(sizes)
    of = spark.createDataFrame([(c, *x) for c, x in shelves.items()], "cell int, first int, pieces int")
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("pieces"))).cast("int").alias("block")
    placed = placed.join(F.broadcast(of), "cell").select("vec_id", "embedding", "cell", block)
    n_blocks = 1 + max((a + p - 1 for a, p in shelves.values()), default=0)
    placed.repartition(min(n_blocks, 4096), "block").write.partitionBy("cell").parquet(path)
    return VectorIndex(path, centres, n, kind, shelves)


def shelved(sizes: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """(first block, number of blocks) of each cell (cell, rows): cells in order share a block until it is full."""
    out, block, held = {}, 0, 0
    for cell, rows in sizes:
        pieces = -(-rows // ROW_BLOCK)
        if held and held + rows > ROW_BLOCK:
            block, held = block + 1, 0
        out[cell] = (block, max(1, pieces))
        block, held = (block + pieces, 0) if pieces > 1 else (block, held + rows)
    return out


def probed(index: VectorIndex, probes: DataFrame) -> DataFrame:
    """The lists that the probes name; the cells are at most CELLS numbers, so the scan gets them as partition filters."""
    cells = [r[0] for r in probes.select("cell").distinct().collect()]
    return index.lists(probes.sparkSession).filter(F.col("cell").isin(cells))


def search(index: VectorIndex, queries: DataFrame, k: int, n_probes: int) -> DataFrame:
    """(query_id, vec_id, score, rank): the k nearest rows by cosine in the n_probes nearest lists; ties by id."""
    spark = queries.sparkSession
    n = min(n_probes, len(index.centres))
    if not n:
        return spark.createDataFrame([], "query_id bigint, vec_id bigint, score double, rank int")
    lists = index.lists(spark).filter("cell >= 0") if n == len(index.centres) else probed(index, index.cells(queries, n))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    left = lists.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = index.asked(queries, n).withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))

    def best(rows: pa.Table, asked: pa.Table) -> pa.Table:
        return nearest(rows["vec_id"], rows["embedding"], asked["query_id"], asked["query"], k, rows["cell"], asked["cells"])

    both = left.groupBy("block", "qb").cogroup(right.groupBy("block", "qb")).applyInArrow(best, "query_id bigint, vec_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def probes_for(index: VectorIndex, queries: DataFrame, k: int, target: float = 0.95, sample: int = 200) -> int:
    """The least number of probed lists that holds a share of target of the exact k nearest rows of a sample of queries.

    The sample (those with the smallest hash of their id) is searched once in all lists; at which place of its query's
    order the list of each neighbour stands tells the recall of every number of probes."""
    every = len(index.centres)
    some = queries.filter(_usable("query")).orderBy(F.xxhash64("query_id"), "query_id").limit(sample)
    found = search(index, some, k, every).select("query_id", "vec_id")
    lists = index.lists(queries.sparkSession).select("vec_id", "cell")
    placed = found.join(lists, "vec_id").join(index.probes(some, every), ["query_id", "cell"])
    counts = {r[0]: r[1] for r in placed.groupBy("place").count().collect()}
    held, total = 0, sum(counts.values())
    for place in range(every):
        held += counts.get(place, 0)
        if held >= target * total:
            return place + 1
    return max(1, every)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, wanted, found, recall) of each query of the exact result."""
    hit = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    per = hit.groupBy("query_id").agg(F.count("*").alias("wanted"), F.count("hit").alias("found"))
    return per.withColumn("recall", F.col("found") / F.col("wanted"))
