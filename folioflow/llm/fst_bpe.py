"""BPE encoding through a lexicon of frequent pieces, compiled into a minimal acyclic transducer.

The frequent pieces of the corpus (counted over all documents) and their id sequences become a shared-suffix automaton:
equal tails are one state, and the outputs on the arcs add up to a word's number, under which its ids are stored.
The automaton is a few flat arrays in one file that each worker maps into memory. A piece that the automaton does
not accept is merged exactly, pair by pair in rank order. Which pieces are in the lexicon never changes a result.

Defined cases: a null text is empty, has no ids and decodes to an empty text; repeated rows are encoded each time;
no rows give an empty result and an empty lexicon; extra columns are ignored or kept as asked.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import tempfile
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe_text, common

#: Pieces in the lexicon; the file is a few megabytes, whatever the corpus.
LEXICON = 50_000
_MAGIC = b"FLEX1\n\0\0"
_NO_PAIR, _ID = 1 << 62, (1 << 32) - 1
#: Ids that are decoded at a time, so a text of any length takes a bounded space for places.
_DECODED = 1 << 16


class Merges:
    """The vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        to_byte = {c: b for b, c in bpe_text.byte_characters().items()}
        vocab = model["vocab"]
        self.text = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items() if all(c in to_byte for c in t)}
        self.text |= {i: t.encode() for t, i in bpe_text.added(path).items()}
        self.added = {t: i for t, i in bpe_text.added(path).items()}
        self.byte = [vocab[c] for c in sorted(to_byte, key=to_byte.get)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Pair -> rank and merged id in one integer, so that the smallest is the pair to merge.
        self.rank = {(vocab[a], vocab[b]): k << 32 | vocab[a + b] for k, (a, b) in enumerate(pairs)}
        tokens = [self.text.get(i, b"") for i in range(max(self.text) + 1)]
        self.sizes = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: the pair of lowest rank, the leftmost at ties, is merged until none is left. A merge
        changes only the two pairs beside it."""
        ids = [self.byte[b] for b in piece]
        if len(ids) > 48:
            return self._merge_long(ids)
        get = self.rank.get
        codes = [get(p, _NO_PAIR) for p in zip(ids, ids[1:])]  # noqa: B905
        while codes and (best := min(codes)) != _NO_PAIR:
            i = codes.index(best)
            ids[i : i + 2] = (best & _ID,)
            del codes[i]
            if i:
                codes[i - 1] = get((ids[i - 1], ids[i]), _NO_PAIR)
            if i < len(codes):
                codes[i] = get((ids[i], ids[i + 1]), _NO_PAIR)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a queue over a linked list, so a piece of a million bytes takes n log n steps."""
        rank, n = self.rank, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]  # noqa: B905
        heapq.heapify(queue)
        while queue:
            k, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            if rank.get((ids[i], ids[j])) != k:
                continue
            ids[i], ids[j] = k & _ID, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if p := rank.get((ids[i], ids[after[i]])):
                    heapq.heappush(queue, (p, i))
            if before[i] >= 0 and (p := rank.get((ids[before[i]], ids[i]))):
                heapq.heappush(queue, (p, before[i]))
        return [x for x in ids if x >= 0]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Words with id outputs as the bytes of a minimal acyclic transducer.

    Words come in sorted order; when a word leaves a branch, that branch's states are final in shape and are replaced
    by equal ones seen before, so every tail is stored once."""
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    seen: dict[tuple, int] = {}

    def settle(path: list[tuple[int, int, int]], down_to: int) -> None:
        while len(path) > down_to:
            parent, label, child = path.pop()
            key = (final[child], tuple(arcs[child].items()))
            arcs[parent][label] = seen.setdefault(key, child)

    words = sorted(entries)
    path: list[tuple[int, int, int]] = []
    last = b""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        settle(path, same)
        at = path[-1][2] if path else 0
        for b in word[same:]:
            arcs.append({})
            final.append(False)
            child = len(arcs) - 1
            arcs[at][b] = child
            path.append((at, b, child))
            at = child
        final[at] = True
        last = word
    settle(path, 0)

    number, order, stack = {}, [], [0]
    while stack:  # states in use, numbered from the start state on
        s = stack.pop()
        if s not in number:
            number[s] = len(order)
            order.append(s)
            stack += arcs[s].values()
    below: dict[int, int] = {}

    def count(root: int) -> None:
        todo = [root]
        while todo:
            s = todo[-1]
            rest = [t for t in arcs[s].values() if t not in below]
            if rest:
                todo += rest
            else:
                below[s] = final[s] + sum(below[t] for t in arcs[s].values())
                todo.pop()

    count(0)
    first, labels, targets, adds, ends = [0], [], [], [], []
    for s in order:
        skipped = int(final[s])
        for b, t in sorted(arcs[s].items()):
            labels.append(b)
            targets.append(number[t])
            adds.append(skipped)
            skipped += below[t]
        first.append(len(labels))
        ends.append(final[s])
    outputs = [entries[w] for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in outputs])]) if outputs else np.zeros(1)
    arrays = [np.array(first, "<u4"), np.array(targets, "<u4"), np.array(adds, "<u4"), offsets.astype("<u4"), np.array([i for x in outputs for i in x], "<u4"), np.array(ends, "u1"), np.array(labels, "u1")]
    return _MAGIC + struct.pack("<7Q", *(len(a) for a in arrays)) + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon mapped from its file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        if data[:8].tobytes() != _MAGIC:
            raise ValueError("no lexicon")
        at, found = 64, []
        for n, kind in zip(struct.unpack("<7Q", data[8:64].tobytes()), ("<u4",) * 5 + ("u1",) * 2, strict=True):
            size = n * np.dtype(kind).itemsize
            found.append(memoryview(data[at : at + size]).cast("I" if kind == "<u4" else "B") if n else memoryview(b""))
            at += size
        self.first, self.targets, self.adds, self.offsets, self.ids, self.ends, self.labels = found
        self.data = data

    @property
    def n_states(self) -> int:
        return len(self.ends)

    def get(self, word: bytes) -> bytes | None:
        """The ids of a word as little-endian unsigned 32-bit integers; None if it is not in the lexicon."""
        first, labels, targets, adds = self.first, self.labels, self.targets, self.adds
        state = total = 0
        for b in word:
            low, high = first[state], first[state + 1]
            k = bisect_left(labels, b, low, high)
            if k == high or labels[k] != b:
                return None
            total += adds[k]
            state = targets[k]
        if not self.ends[state]:
            return None
        return bytes(self.ids[self.offsets[total] : self.offsets[total + 1]])


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def mapped(data: bytes) -> Lexicon:
    """The lexicon from a file of the worker's own, unlinked at once: the mapping keeps it alive, nothing is left behind."""
    with tempfile.NamedTemporaryFile(suffix=".flex") as f:
        f.write(data)
        f.flush()
        return Lexicon(f.name)


class Encoder(dict):
    """Piece -> ids, by the lexicon or else by exact merging; remembers at most `limit` pieces of those seen."""

    def __init__(self, path: str, lexicon: Lexicon, limit: int = 800_000):
        super().__init__()
        self.path, self.lexicon, self.bpe, self.limit = path, lexicon, merges(path), limit

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        got = self.lexicon.get(piece.encode())
        if got is None:
            ids = [self.bpe.added[piece]] if piece in self.bpe.added else self.bpe.merge(piece.encode())
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 256:
            self[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, bpe_text.pieces(text, self.path)))

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of the decoded text. Bytes that are no UTF-8 become the replacement character."""
        all_ids, parts = np.frombuffer(ids, "<u4"), []
        for at in range(0, len(all_ids), _DECODED):
            chosen = all_ids[at : at + _DECODED]
            sizes = self.bpe.sizes[chosen]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(self.bpe.starts[chosen] - (ends - sizes), sizes)
            parts.append(self.bpe.blob[places].tobytes())
        data = b"".join(parts)
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode(errors="replace").encode()
        return data


@lru_cache(maxsize=1)
def encoder(path: str, lexicon: bytes, limit: int) -> Encoder:
    return Encoder(path, mapped(lexicon), limit)


def frequent_pieces(docs: DataFrame, path: str, most: int = LEXICON, flush: int = 150_000) -> list[str]:
    """The most frequent pieces over all documents, at most `most`: counts fall into steps of a sixteenth of an octave,
    and whole steps are taken from the top.

    Each task adds up what it reads and passes its sums on when it holds `flush` pieces. The driver gets some hundred
    steps and the chosen pieces, whatever the number of tasks."""

    def run(batches):
        got: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], ["piece", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                got.update(bpe_text.pieces(text, path))
                if len(got) > flush:
                    yield out()
                    got.clear()
        if got:
            yield out()

    spark = docs.sparkSession
    sums = docs.select(common.text_of().alias("text")).mapInArrow(common.lean(run), "piece string, n bigint").filter(F.length("piece") <= 64).groupBy("piece").agg(F.sum("n").alias("n"))
    counts, at = common.written(sums.filter("n > 1").withColumn("step", F.floor(F.log2("n") * 16).cast("int")), "piece-counts")
    held, lowest = 0, None
    for r in counts.groupBy("step").agg(F.count("*").alias("k")).orderBy(F.desc("step")).collect():
        held += r["k"]
        if held > most:
            break
        lowest = r["step"]
    found = [] if lowest is None else [r["piece"] for r in counts.filter(F.col("step") >= lowest).select("piece").collect()]
    common.remove(spark, at)
    return sorted(found)


def build_lexicon(docs: DataFrame, path: str | None = None, most: int = LEXICON) -> bytes:
    common.ship_code(docs.sparkSession)
    path = path or bpe_text.default_path()
    bpe = merges(path)
    return compile_lexicon({p.encode(): bpe.merge(p.encode()) for p in frequent_pieces(docs, path, most) if p not in bpe.added})


def encode_decode(docs: DataFrame, lexicon: bytes, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), full: bool = False, memo: int = 800_000) -> DataFrame:
    """The kept columns, n_tokens, and digests of the ids and of the text decoded from them; full adds both themselves.

    memo: pieces that a worker remembers with their ids, some 250 bytes each."""
    spark = docs.sparkSession
    common.ship_code(spark)
    path = path or bpe_text.default_path()
    shared = spark.sparkContext.broadcast(lexicon)
    chosen = docs.select(*keep, common.text_of().alias("_text"))
    schema = chosen.drop("_text").selectExpr("*", "0L n_tokens", "'' ids_sha256", "'' decoded_sha256", *(["array(0) ids", "'' decoded"] if full else [])).schema

    def run(batches):
        own = encoder(path, shared.value, memo)
        for batch in batches:
            n, a, b, ids, texts = [], [], [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                got = own.encode(text)
                back = own.decode(got)
                n.append(len(got) // 4)
                a.append(hashlib.sha256(got).hexdigest())
                b.append(hashlib.sha256(back).hexdigest())
                if full:
                    ids.append(np.frombuffer(got, "<i4"))
                    texts.append(back.decode())
            more = [(pa.array(n, pa.int64()), "n_tokens"), (pa.array(a, pa.string()), "ids_sha256"), (pa.array(b, pa.string()), "decoded_sha256")]
            if full:
                more += [(pa.array(ids, pa.list_(pa.int32())), "ids"), (pa.array(texts, pa.string()), "decoded")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(x for x, _ in more)], [*batch.schema.names[:-1], *(x for _, x in more)])

    return chosen.mapInArrow(common.lean(run), schema)
