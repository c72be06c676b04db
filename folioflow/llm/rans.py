"""Token ids as a compact binary file set: a static range asymmetric numeral system.

One frequency table over the ids of all documents is shared by every block. Blocks (about a million ids of whole
documents) are independent; inside a block, lanes are interleaved so that one vector step codes one id of each lane.
A block carries its documents' ids and lengths, lane states, checkpoints inside the block from which a second reader
can start, and a checksum of its stored bytes; decoding must end in the coder's first state.

Defined cases: a null text is empty and has only the end id; repeated rows are stored as often as they occur;
documents with equal ids are ordered by text hash; a null doc_id comes first; no rows give an empty result;
other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe_text, common

SCALE = 20
LOW = np.uint64(1 << 31)
_MAGIC = b"FRANS1\n\0"
_HEAD = struct.Struct("<8sIIIIII")  # magic, documents, ids, lanes, words, checkpoints, crc of body
BLOCK_IDS = 1 << 20
LANES = 4096
CHECK_STEPS = 128


def normalised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE; every id that occurs has at least 1."""
    used = np.flatnonzero(counts)
    total = int(counts.sum())
    if len(used) > 1 << (SCALE - 1):
        raise ValueError("vocabulary too large for the table")
    freq = np.zeros(len(counts), np.int64)
    if not total:
        return freq
    freq[used] = np.maximum(1, (counts[used].astype(np.float64) / total * (1 << SCALE)).astype(np.int64))
    rest = (1 << SCALE) - int(freq.sum())
    order = used[np.argsort(-freq[used], kind="stable")]
    if rest > 0:
        freq[order[0]] += rest
    i = 0
    while rest < 0:
        take = min(-rest, max(0, int(freq[order[i]]) // 2))
        freq[order[i]] -= take
        rest += take
        i += 1
    return freq


class Table:
    """The shared frequencies, their sums, and the id of each slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self._slots = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint16 if len(self.freq) <= 1 << 16 else np.uint32), self.freq.astype(np.int64))
        return self._slots


def encode(ids: np.ndarray, table: Table, lanes: int) -> tuple[np.ndarray, np.ndarray, list]:
    """(words, lane states, checkpoints of (step, word at which a reader goes on, states))."""
    x = np.full(lanes, LOW, np.uint64)
    steps = -(-len(ids) // lanes)
    freq, cum = table.freq[ids], table.cum[ids]
    shift, low, word = np.uint64(63 - SCALE), np.uint64(0xFFFFFFFF), np.uint64(32)
    chunks, marks, n = [], [], 0
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], cum[t * lanes : (t + 1) * lanes]
        xs = x[: len(f)]
        full = xs >= (f << shift)
        if full.any():
            out = xs[full]
            chunks.append((out & low).astype("<u4"))
            n += len(out)
            xs[full] = out >> word
        q = xs // f
        x[: len(f)] = (q << np.uint64(SCALE)) + (xs - q * f) + c
        if t and t % CHECK_STEPS == 0:
            marks.append((t, n, x.copy()))
    words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    return words, x, [(t, len(words) - k, s) for t, k, s in marks[::-1]]


def decode(words: np.ndarray, states: np.ndarray, n: int, table: Table, first: int = 0, at: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of steps first to last (exclusive; None: the end), read from word `at` on."""
    lanes = len(states)
    x = states.astype(np.uint64).copy()
    mask, scale, word = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    steps = -(-n // lanes)
    stop = steps if last is None else min(last, steps)
    out = np.empty(max(0, min(stop * lanes, n) - first * lanes), np.uint32)
    slots, freq, cum = table.slots, table.freq, table.cum
    for t in range(first, stop):
        m = min(lanes, n - t * lanes)
        xs = x[:m]
        slot = xs & mask
        ids = slots[slot]
        out[(t - first) * lanes : (t - first) * lanes + m] = ids
        xs = freq[ids] * (xs >> scale) + slot - cum[ids]
        short = xs < LOW
        k = int(np.count_nonzero(short))
        if k:
            xs[short] = (xs[short] << word) | words[at : at + k].astype(np.uint64)
            at += k
        x[:m] = xs
    if last is None and (at != len(words) or (x != LOW).any()):
        raise ValueError("damaged block: the coder did not end in its first state")
    return out


def pack(doc_ids: list, lens: np.ndarray, ids: np.ndarray, table: Table) -> bytes:
    lanes = int(min(LANES, max(1, len(ids) // 64)))
    words, states, marks = encode(ids, table, lanes)
    body = b"".join(
        [
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is None for x in doc_ids], np.uint8).tobytes(),
            lens.astype("<u4").tobytes(),
            states.astype("<u8").tobytes(),
            *(struct.pack("<II", t, at) + s.astype("<u8").tobytes() for t, at, s in marks),
            words.tobytes(),
        ]
    )
    return _HEAD.pack(_MAGIC, len(doc_ids), len(ids), lanes, len(words), len(marks), zlib.crc32(body)) + body


def unpack(data: bytes, table: Table) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids) of a stored block, its checksums verified; the parts between checkpoints are decoded one by one."""
    magic, docs, n, lanes, n_words, n_marks, crc_body = _HEAD.unpack_from(data)
    body = memoryview(data)[_HEAD.size :]
    if magic != _MAGIC or zlib.crc32(body) != crc_body:
        raise ValueError("damaged block: header or checksum of the stored bytes")
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(body, kind, count, at)
        at += got.nbytes
        return got

    doc_ids, null, lens, states = take("<i8", docs), take("u1", docs), take("<u4", docs), take("<u8", lanes)
    marks = []
    for _ in range(n_marks):
        t, w = take("<u4", 2)
        marks.append((int(t), int(w), take("<u8", lanes)))
    words = take("<u4", n_words)
    starts = [(0, 0, states), *marks]
    ends = [t for t, _, _ in marks] + [None]
    ids = np.concatenate([decode(words, s, n, table, t, w, e) for (t, w, s), e in zip(starts, ends, strict=True)])
    return [None if z else int(d) for d, z in zip(doc_ids, null, strict=True)], lens.astype(np.int64), ids


_BLOCKS = "part int, block int, doc_ids array<bigint>, lens array<bigint>, ids binary, n_ids bigint, counts binary"


def blocks_of(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Rows (doc_id, text) as blocks of whole documents in ascending doc_id order: ordered by part, then block."""
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text"))
        .repartitionByRange(common.cores(spark), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .withColumn("part", F.spark_partition_id())
    )
    end = struct.pack("<I", end_id)

    def run(batches):
        held: list = []
        size, block, part = 0, 0, 0

        def out():
            ids = np.frombuffer(b"".join(x[1] for x in held), "<u4")
            small = ids.astype("<u2") if len(ids) == 0 or ids.max() < 1 << 16 else ids
            row = {"part": part, "block": block, "doc_ids": [x[0] for x in held], "lens": [len(x[1]) // 4 for x in held], "ids": bytes([small.itemsize]) + small.tobytes(), "n_ids": len(ids), "counts": _sparse(ids)}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("ids", pa.binary()), ("n_ids", pa.int64()), ("counts", pa.binary())]))

        for batch in batches:
            ids, texts, parts = (batch.column(i).to_pylist() for i in range(3))
            for doc_id, coded, p in zip(ids, bpe_text.encode_all(texts, tokenizer), parts, strict=True):
                part = p
                held.append((doc_id, coded + end))
                size += len(held[-1][1]) // 4
                if size >= block_ids:
                    yield out()
                    held, size, block = [], 0, block + 1
        if held:
            yield out()

    return ordered.mapInArrow(common.lean(run), _BLOCKS)


def _ids(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, f"<u{stored[0]}", -1, 1)


def _sparse(ids: np.ndarray) -> bytes:
    got = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    used = np.flatnonzero(got)
    return np.stack([used, got[used]]).astype("<u4").tobytes()


def frequencies(blocks: DataFrame) -> np.ndarray:
    """Counts of every id over all blocks, from the counts that each block brings along: the result is as long as the
    vocabulary, whatever the corpus."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for stored in batch.column(0):
                ids, n = np.frombuffer(stored.as_py(), "<u4").reshape(2, -1)
                if len(ids) and ids[-1] >= len(total):
                    total = np.concatenate([total, np.zeros(int(ids[-1]) + 1 - len(total), np.int64)])
                total[ids] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = blocks.select("counts").mapInArrow(common.lean(run), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in rows], default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


_INDEX = "part int, block int, file string, offset bigint, length bigint, n_docs bigint, n_ids bigint"


def write_files(blocks: DataFrame, freq: np.ndarray, folder: str) -> DataFrame:
    """Writes the blocks to files in folder, one file a task, and gives the index rows (lazily: materialise it once)."""
    table = blocks.sparkSession.sparkContext.broadcast(freq.astype(np.int32))

    def run(batches):
        own, out, stem = Table(table.value), None, ""
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None:
                    out = common.SharedFile(folder, f"ids-{r['part']:05d}-{r['block']:05d}", ".frans")
                data = pack(r["doc_ids"], np.array(r["lens"], np.int64), _ids(r["ids"]), own)
                rows.append((r["part"], r["block"], out.name, out.write(data), len(data), len(r["lens"]), r["n_ids"]))
            if rows:
                stem = rows
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "block", "file", "offset", "length", "n_docs", "n_ids"])
        if stem:
            out.close()

    return blocks.drop("counts").mapInArrow(common.lean(run), _INDEX)


def with_start(index: DataFrame) -> DataFrame:
    """Adds the number of ids before each block. Only one row a part meets in a single task."""
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select("file", "offset", "length", (F.col("_base") + F.col("_in")).alias("start"))


def read_files(index: DataFrame, freq: np.ndarray, folder: str) -> DataFrame:
    """Decodes the indexed blocks: one row a document with its place, its number of ids and their checksum."""
    spark = index.sparkSession
    table = spark.sparkContext.broadcast(freq.astype(np.int32))

    def run(batches):
        own = Table(table.value)
        fs, root = common.store(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{root}/{r['file']}") as f:
                    f.seek(r["offset"])
                    doc_ids, lens, ids = unpack(f.read(r["length"]), own)
                ends = np.cumsum(lens)
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(r["start"] + ends - lens), pa.array(lens), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return index.repartition(common.cores(spark), "file", "offset").mapInArrow(common.lean(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encodes, writes, and reads back all documents; the files stay in the shared folder.

    Three passes: ids in blocks (written once, so the text is encoded once), the shared table, the coded files."""
    spark = docs.sparkSession
    common.ship_code(spark)
    blocks, at = common.written(blocks_of(docs, tokenizer or bpe_text.default_path(), end_id, block_ids), "id-blocks", "zstd")
    freq = normalised(frequencies(blocks))
    folder = common.new_path(spark, "token-files")
    index, _ = common.written(write_files(blocks, freq, folder), "token-index")
    common.remove(spark, at)
    return read_files(with_start(index), freq, folder)
