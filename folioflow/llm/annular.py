"""Vector codes by product quantisation, with nearest entries found by annular pruning on norms.

Components become integers, vectors are cut into equal parts, and every part position has a codebook that Lloyd rounds
refine. |x| and |c| differ by at most |x - c|, so with the entries of a codebook sorted by norm the nearest entry lies in
the annulus |x| - d .. |x| + d of any distance d already reached: d comes from the entries next to |x| in norm, a binary
search finds the annulus, and all entries inside it, borders included, are compared in exact integers.

Scale: a round is one scan; a task sends at most parts x entries rows of component sums, added up by key before the
driver gets the new codebooks (parts x entries x width numbers, whatever the input). The errors of a label are a
grouped sum joined back, which adaptive execution splits where a label is hot. How much the annuli leave out depends on
the vectors: of 256 entries about 5 % for parts of 16 independent components, most where norms differ.

Defined cases: rows whose vector is null, has null or non-finite components, or has another length than the vector of the
smallest kept id, are dropped; the length must be a multiple of the number of parts. Scaled components are held to +-2^26,
so that distances fit 64 bits. Equal ids are separate rows (as first entries ordered by vector), null ids come last;
fewer rows than entries give so many entries; equal distances go to the lower index; an entry of no part stays. An empty
table gives no rows. Columns beside the named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BOUND = 1 << 26
#: Entries next to a block's norms that give the first distances; parts in a block.
NEAR, BLOCK = 8, 256


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part, before their length is looked at."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))


def scaled(v: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(v * SCALE), -BOUND, BOUND).astype(np.int64)


class Book:
    """The entries of one part position, sorted by norm.

    Parts are taken in blocks of like norm, so that their annuli overlap: a block is compared with the union of its annuli
    as one matrix product, and what lies outside a part's own annulus is left out. Doubles hold the whole numbers exactly
    as long as no sum passes 2^53; beyond, the same product runs on 64-bit integers."""

    def __init__(self, entries: np.ndarray):
        norms = np.sqrt((entries.astype(np.float64) ** 2).sum(axis=1))
        self.by_norm = np.argsort(norms, kind="stable")
        self.norms, self.entries = norms[self.by_norm], entries[self.by_norm]
        self.largest = int(np.abs(entries).max(initial=0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of the nearest entry of each row of x, and how many pairs lay in an annulus."""
        index, best, pairs = np.empty(len(x), np.int64), np.empty(len(x), np.int64), 0
        size, width = len(self.norms), x.shape[1]
        largest = max(self.largest, int(np.abs(x).max(initial=0)))
        kind = np.float64 if 4 * width * largest * largest < 1 << 53 else np.int64
        x, entries = x.astype(kind), self.entries.astype(kind)
        squares, entry_squares = (x * x).sum(axis=1), (entries * entries).sum(axis=1)
        norm = np.sqrt(squares.astype(np.float64))
        order = np.argsort(norm, kind="stable")
        for at in range(0, len(x), BLOCK):
            rows = order[at : at + BLOCK]
            block, n = x[rows], norm[rows]

            def distances(low: int, high: int, block=block, rows=rows) -> np.ndarray:
                return squares[rows, None] - 2 * (block @ entries[low:high].T) + entry_squares[None, low:high]

            next_to = np.clip(np.searchsorted(self.norms, n[[0, -1]]) + [-NEAR // 2, NEAR // 2], 0, size)
            low, high = int(min(next_to[0], max(size - NEAR, 0))), int(max(next_to[1], min(NEAR, size)))
            reach = np.sqrt(distances(low, high).min(axis=1).astype(np.float64))
            slack = 1e-9 * (n + reach) + 1e-6  # wider than what doubles round off
            lows, highs = np.searchsorted(self.norms, n - reach - slack, side="left"), np.searchsorted(self.norms, n + reach + slack, side="right")
            low, high = int(lows.min()), int(highs.max())
            d, place = distances(low, high), np.arange(low, high)
            inside = (place >= lows[:, None]) & (place < highs[:, None])
            least = np.where(inside, d, np.iinfo(np.int64).max if kind is np.int64 else np.inf).min(axis=1)
            index[rows] = np.where(inside & (d == least[:, None]), self.by_norm[low:high], size).min(axis=1)
            best[rows] = least.astype(np.int64)
            pairs += int((highs - lows).sum())
        return index, best, pairs


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of the given width as integers, and the places of their rows."""
    sizes = np.asarray(column.value_lengths())
    rows = np.flatnonzero(sizes == width)
    column = column.take(pa.array(rows)) if len(rows) < len(sizes) else column
    return scaled(np.asarray(column.flatten()).reshape(len(rows), width)), rows


def _sums(books: np.ndarray):
    """A worker that assigns vectors and gives, once a task, (part, entry, n, sums) of the entries it met."""
    parts, size, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Book(b) for b in books]
        n, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, step), np.int64)
        for batch in batches:
            x, _ = _matrix(batch.column(0), parts * step)
            for p, book in enumerate(found):
                part = x[:, p * step : (p + 1) * step]
                index, _, _ = book.nearest(part)
                n[p] += np.bincount(index, minlength=size)
                np.add.at(total[p], index, part)
        part, entry = np.nonzero(n)
        sums = total[part, entry]
        names = ["part", "entry", "n", *(f"s{i}" for i in range(step))]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(entry.astype(np.int64)), pa.array(n[part, entry]), *(pa.array(sums[:, i]) for i in range(step))], names)

    return run


def trained(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks of shape (parts, entries, width of a part); None if there is no row."""
    rows = kept(vectors)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries)
    width = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("w")).limit(1).collect()
    if not width:
        return None
    width = width[0].w
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == width)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    step = width // parts
    books = scaled(np.array([r.v for r in first]).reshape(len(first), parts, step)).transpose(1, 0, 2).copy()
    kinds = ", ".join(["part long", "entry long", "n long", *(f"s{i} long" for i in range(step))])
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(_sums(books), kinds).groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(step)))
        for r in sums.collect():  # parts x entries rows
            books[r.part, r.entry] = np.array(r[3:], np.int64) // r.n
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def coded(vectors: DataFrame, books: np.ndarray | None) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every row that takes part."""
    spark, kinds = vectors.sparkSession, "vec_id long, label " + vectors.schema["label"].dataType.simpleString() + ", code string, error long"
    if books is None:
        return spark.createDataFrame([], kinds)
    parts, _, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Book(b) for b in books]
        for batch in batches:
            x, rows = _matrix(batch.column(2), parts * step)
            each = [book.nearest(x[:, p * step : (p + 1) * step]) for p, book in enumerate(found)]
            codes = ["".join(f"{i:02x}" for i in row) for row in zip(*(e[0].tolist() for e in each), strict=True)]
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(codes, pa.string()), pa.array(sum(e[1] for e in each))], ["vec_id", "label", "code", "error"])

    return kept(vectors).mapInArrow(run, kinds)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error, the errors summed over rows of one label; rows without a label are together."""
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def of_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of op12: vec_id, code, error, label_error and the digest of the codebooks."""
    common.ship_code(spark)
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = trained(vectors)
    codes, _ = common.written(coded(vectors, books), "codes")  # both sides of the join read them
    codes = with_label_errors(codes)
    return codes.select("vec_id", "code", "error", "label_error", F.lit(None if books is None else digest(books)).cast("string").alias("codebooks_sha256"), "label")
