"""Removal of repeated 200-byte strings by suffix sorting: deep-shallow, over sampled suffixes.

Every 200-byte window has a designated anchor: of its 32-byte grams the one with the smallest hash, the leftmost at
ties. Equal windows have their anchors at the same place in them, so a window that occurs again shows as an anchor
that occurs again, and only about one position in 85 is an anchor. The windows of one anchor occurrence lie in its
context, 368 bytes at most. Occurrences with equal contexts are repeated as a whole; they are found by hash and
collapse before anything is joined. What is left are occurrences of one gram in different contexts, one of each
context: there the suffixes from the anchor on, and the reversed prefixes before it, are sorted by deep-shallow sorting
(multikey quicksort to a shallow depth, then blind tries for the groups with longer common prefixes). Common prefixes
to both sides tell which windows occur in another context too.
A gram with more than LIMIT contexts is split: its windows are grouped by stretches of 16 places of the anchor, whose
common core is hashed into the key, and what is still large by single windows, whose key is the window itself.

Texts are UTF-8 bytes; matches never cross documents; bytes are judged on the input.
Defined cases: null and empty texts have no bytes and lose none; texts shorter than the length keep everything; rows
with equal texts are occurrences of their own, so all of a copied text of 200 bytes or more goes; no rows give an empty
result; other columns are ignored or kept; a text of any length is hashed in overlapping stretches. Texts are told apart
by 64-bit hashes and their numbers of bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .chosen_path import mix

LENGTH, GRAM = 200, 32
LIMIT = 256
#: Bytes compared by multikey quicksort before blind tries take over.
SHALLOW = 48
#: Bytes of a text hashed at a time; stretches overlap, so nothing is lost between them.
STRETCH = 4 << 20

_BASE = 0x9E3779B97F4A7C15
_K = np.uint64(0xD6E8FEB86659FD93)


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_POWERS = Powers()


def _prefix(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the factors that make substring hashes independent of their place."""
    up, down = _POWERS.get(len(b) + 1)
    h = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(b * up[: len(b)], out=h[1:])
    return h, down


def anchors(b: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, context hash, first window, last window, anchor) for each run of windows with the same anchor."""
    w = length - gram + 1
    h, down = _prefix(b)
    g = mix((h[gram:] - h[:-gram]) * down[: len(b) - gram + 1])
    v = (g & ~np.uint64(0xFFFFFF)) | np.arange(len(g), dtype=np.uint64)
    a = np.concatenate([v, np.full(-len(v) % w, ~np.uint64(0))]).reshape(-1, w)
    left = np.minimum.accumulate(a, axis=1).ravel()
    right = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(right[: len(v) - w + 1], left[w - 1 : len(v)]) & np.uint64(0xFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(at) - 1]])
    p = at[first]
    context = mix((h[last + length] - h[first]) * down[first] + (p - first).astype(np.uint64) * _K + (last - first).astype(np.uint64))
    return g[p], context, first, last, p


_TEXT = ["text_key", "size"]


def _text_key(text: str) -> list:
    """What texts are told apart by: a 64-bit hash and the number of bytes."""
    return [F.xxhash64(text).alias("text_key"), F.octet_length(text).alias("size")]


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    """(key, context, text_key, size, pos) of every anchor occurrence; pos packs the first window, the number of windows
    after it, and the bytes between the first window's start and the anchor."""
    own = docs.select(common.text_of().alias("text")).select(*_text_key("text"), "text")
    if length - GRAM > 255:
        raise ValueError("windows this long need another packing")

    def run(batches):
        for batch in batches:
            parts, of = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                b = np.frombuffer(text.encode(), np.uint8)
                for at in range(0, max(1, len(b) - length + 1), STRETCH):
                    piece = b[at : at + STRETCH + length - 1]
                    if len(piece) >= length:
                        key, context, first, last, p = anchors(piece, length)
                        parts.append(np.stack([key.view(np.int64), context.view(np.int64), (first + at) << 16 | (last - first) << 8 | (p - first)]))
                        of.append(np.full(len(key), i))
            if parts:
                cols = np.concatenate(parts, axis=1)
                rows = pa.array(np.concatenate(of))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(cols[2])], ["key", "context", "text_key", "size", "pos"])

    return own.mapInArrow(common.lean(run), "key bigint, context bigint, text_key bigint, size int, pos bigint")


def _unpacked() -> list:
    first = F.shiftright("pos", 16)
    last = first + F.shiftright("pos", 8).bitwiseAND(F.lit(255))
    return [F.col("pos").bitwiseAND(F.lit(255)).cast("int").alias("before"), first.cast("int").alias("first"), last.cast("int").alias("last")]


# Deep-shallow sorting of byte strings.


def shallow_groups(strings: list[bytes], order: list[int], depth: int, limit: int) -> list[tuple[list[int], int]]:
    """Multikey quicksort by bytes from `depth` to `limit`: groups in order, each with the depth to which it is equal.
    A group of one is sorted; a larger one ended at the limit, or all its strings did."""
    out: list[tuple[list[int], int]] = []
    todo = [(order, depth)]
    while todo:
        part, d = todo.pop()
        if len(part) <= 1 or d >= limit:
            if part:
                out.append((part, d))
            continue
        firsts = [strings[i][d : d + 1] for i in part]
        pivot = sorted(firsts[:: max(1, len(firsts) // 9)])[min(len(firsts), 9) // 2 if len(firsts) >= 9 else len(firsts) // 2]
        less = [i for i, c in zip(part, firsts, strict=True) if c < pivot]
        same = [i for i, c in zip(part, firsts, strict=True) if c == pivot]
        more = [i for i, c in zip(part, firsts, strict=True) if c > pivot]
        todo.append((more, d))
        if pivot == b"":
            out.append((same, d)) if not less else todo.append((same, limit))
        else:
            todo.append((same, d + 1))
        todo.append((less, d))
    return out


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be `start` at least."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    low, high = start, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """A trie that keeps only the places where its strings branch, and the branching bytes.

    A string goes down by its bytes at those places alone; one comparison with any string of the leaf reached tells the
    true branching place, and the way down is taken again to it. Ended strings branch off by the byte -1."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: object = None

    @staticmethod
    def byte(s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    def insert(self, i: int, start: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            node = node[1].get(self.byte(s, node[0])) or next(iter(node[1].values()))
        t = self.strings[node[0]]
        depth = common_prefix(s, t, start)
        if depth == len(s) == len(t):
            node.append(i)
            return
        parent, label, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, label = node, self.byte(s, node[0])
            node = node[1][label]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self.byte(s, depth)] = [i]
            return
        new = (depth, {self.byte(t, depth): node, self.byte(s, depth): [i]})
        if parent is None:
            self.root = new
        else:
            parent[1][label] = new

    def in_order(self) -> tuple[list[int], list[int]]:
        """The strings in order, and the common prefix of each with the one before it (-1 for the first)."""
        order: list[int] = []
        lcp: list[int] = []
        todo: list[tuple[object, int]] = [(self.root, -1)]
        while todo:
            node, before = todo.pop()
            if isinstance(node, tuple):
                kids = [node[1][b] for b in sorted(node[1])]
                todo += [(k, node[0]) for k in reversed(kids[1:])]
                todo.append((kids[0], before))
            elif node:
                order += node
                lcp += [before, *(len(self.strings[node[0]]) for _ in node[1:])]
        return order, lcp


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW, start: int = 0) -> tuple[list[int], list[int]]:
    """The order of the strings, known to agree in their first `start` bytes, and the common prefix of each with the one
    before it in that order (-1 for the first)."""
    order: list[int] = []
    lcp: list[int] = []
    for group, depth in shallow_groups(strings, list(range(len(strings))), start, max(shallow, start)):
        if len(group) == 1:
            mine, prefixes = group, [-1]
        elif len(group) == 2:
            a, b = strings[group[0]], strings[group[1]]
            n = common_prefix(a, b, min(depth, len(a), len(b)))
            mine, prefixes = (group if a <= b else group[::-1]), [-1, n]
        else:
            trie = BlindTrie(strings)
            least = min(depth, min(len(strings[i]) for i in group))
            for i in group:
                trie.insert(i, least)
            mine, prefixes = trie.in_order()
        if order:
            prefixes[0] = common_prefix(strings[order[-1]], strings[mine[0]], 0)
        order += mine
        lcp += prefixes
    return order, lcp


def prefix_matrix(strings: list[bytes], start: int = 0) -> np.ndarray:
    """Common prefix lengths of all pairs, from the order and its neighbours' common prefixes."""
    order, lcp = deep_shallow_sort(strings, start=start)
    n = len(order)
    m = np.zeros((n, n), np.int16)
    neighbours = np.array(lcp[1:], np.int16)
    for i in range(n - 1):
        m[i, i + 1 :] = np.minimum.accumulate(neighbours[i:])
    m = np.maximum(m, m.T)
    out = np.empty_like(m)
    out[np.ix_(order, order)] = m
    return out


def repeated_places(contexts: list[bytes], before: list[int], after: list[int], length: int, gram: int = GRAM) -> list[list[tuple[int, int]]]:
    """For contexts of one anchor: the runs of windows of each that occur in another.

    before: bytes before the anchor. after: windows in the context are at 0 .. after. Runs are (first, last) windows."""
    n = len(contexts)
    lefts = [c[:k][::-1] for c, k in zip(contexts, before, strict=True)]
    rights = [c[k:] for c, k in zip(contexts, before, strict=True)]
    if n == 2:
        left = np.array([[0, common_prefix(*lefts)]] * 2)
        right = np.array([[0, common_prefix(*rights)]] * 2)
        left, right = np.maximum(left, left.T), np.maximum(right, right.T)
    else:
        left, right = prefix_matrix(lefts), prefix_matrix(rights, 0)
    k, last = np.array(before)[:, None], np.array(after)[:, None]
    low = np.maximum(k - left.astype(np.int64), 0)  # first window that starts within the common part
    high = np.minimum(k + right.astype(np.int64) - length, last)  # last window that ends within it
    ok = (low <= high) & ~np.eye(n, dtype=bool)
    out: list[list[tuple[int, int]]] = []
    for i in range(n):
        runs: list[tuple[int, int]] = []
        for a, b in sorted(set(zip(low[i][ok[i]].tolist(), high[i][ok[i]].tolist(), strict=True))):
            if runs and a <= runs[-1][1] + 1:
                runs[-1] = (runs[-1][0], max(runs[-1][1], b))
            else:
                runs.append((a, b))
        out.append(runs)
    return out


_COLUMNS = ["key", "context", *_TEXT, "before", "first", "last", "bytes"]
_CONTEXT = "key bigint, context bigint, text_key bigint, size int, before int, first int, last int, bytes binary"


def _cut(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts asked for (key, context, text_key, size, before, first, last). Of equal texts the one with
    the smallest doc_id is read; of repeated rows each, which makes their contexts repeated, as they are."""
    least = F.lit(-(1 << 63)).cast("bigint")
    own = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), least).alias("_id"), common.text_of().alias("text")).select("_id", "text", *_text_key("text"))
    one = own.groupBy(*_TEXT).agg(F.min("_id").alias("_id"))
    of = asked.groupBy(*_TEXT).agg(F.collect_list(F.struct("key", "context", "before", "first", "last")).alias("m")).join(one, _TEXT)

    def run(batches):
        for batch in batches:
            for piece in [batch.slice(k, 256) for k in range(0, len(batch), 256)]:
                each = piece.column(3)
                flat = each.flatten()
                of = np.repeat(np.arange(len(piece)), np.array(each.value_lengths()))
                texts = [t.encode() for t in piece.column(2).to_pylist()]
                cols = dict(zip((f.name for f in flat.type), flat.flatten(), strict=True))
                first, last = np.array(cols["first"]), np.array(cols["last"])
                data = [texts[i][a : b + length] for i, a, b in zip(of.tolist(), first.tolist(), last.tolist(), strict=True)]
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays([cols["key"], cols["context"], piece.column(0).take(rows), piece.column(1).take(rows), cols["before"], cols["first"], cols["last"], pa.array(data, pa.binary())], _COLUMNS)

    return own.join(of, [*_TEXT, "_id"]).select(*_TEXT, "text", "m").mapInArrow(common.lean(run), _CONTEXT)


def _split(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """Contexts as one row a stretch of `width` anchor places, keyed by the bytes that all windows of the stretch share."""

    def run(batches):
        for batch in batches:
            out = []
            for key, _, text_key, size, before, first, last, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a = before - (last - first)  # places of the anchor in the windows: a .. before
                for c in range(max(a, 0) // width, before // width + 1):
                    low, high = max(a, c * width), min(before, c * width + width - 1)
                    start, end = before - high, before - low  # windows of the stretch, within the context
                    core = data[max(0, before - c * width) : before + length - min(c * width + width - 1, length - GRAM)]
                    part = data[start : end + length]
                    new = _hash(core, key, c * 1024 + width)
                    out.append((new, _hash(part, new, (before - start) * 1024 + end - start), text_key, size, before - start, first + start, first + end, part))
            if out:
                kinds = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _COLUMNS)

    return contexts.select(*_COLUMNS).mapInArrow(common.lean(run), _CONTEXT)


def _hash(data: bytes, key: int, salt: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data + salt.to_bytes(8, "little"), seed=key & ((1 << 64) - 1)) - (1 << 63)


def _sorted_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """(text_key, size, first, last): the windows found repeated by sorting each key's contexts."""
    rows = contexts.select(*_COLUMNS).repartition("key").sortWithinPartitions("key")

    def run(batches):
        held: list = []

        def judge(rows):
            runs = repeated_places([r[7] for r in rows], [r[4] for r in rows], [r[6] - r[5] for r in rows], length)
            return [(r[2], r[3], r[5] + a, r[5] + b) for r, own in zip(rows, runs, strict=True) for a, b in own]

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64()] + [pa.int32()] * 3, strict=True)], [*_TEXT, "first", "last"])

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    if len(held) > 1:
                        out += judge(held)
                    held = []
                held.append(row)
            if out:
                yield batch_of(out)
        if len(held) > 1 and (out := judge(held)):
            yield batch_of(out)

    return rows.mapInArrow(common.lean(run), "text_key bigint, size int, first int, last int")


def _shared(rows: DataFrame) -> DataFrame:
    """(key, m) of the keys of more than one row. Written before it is joined, so that Spark can split a hot key's rows."""
    return rows.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")


def repeated_windows(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> tuple[DataFrame, list[str]]:
    """(text_key, size, first, last): runs of starts of windows that occur again, for every different text. May overlap.

    Also the paths of the tables that this reads; they can go when it has been written. Grams that occur once leave
    before anything is joined or cut: most do."""
    spark = docs.sparkSession
    common.ship_code(spark)
    every, every_path = common.written(_occurrences(docs, length), "anchors", "zstd")
    again, again_path = common.written(_shared(every).select("key"), "repeated-grams")
    occ, occ_path = common.written(every.join(again, "key", "left_semi"), "repeated-anchors", "zstd")
    common.remove(spark, every_path, again_path)
    different, different_path = common.written(occ.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(F.struct(*_TEXT, "pos")).alias("o")).select("key", "context", "n", "o.*"), "contexts", "zstd")
    many, many_path = common.written(_shared(different).select("key"), "grams-in-contexts")
    asked = different.join(many, "key", "left_semi").select("key", "context", *_TEXT, *_unpacked())
    contexts, path = common.written(_cut(docs, asked, length), "context-bytes", "zstd")
    whole = occ.join(different.filter("n > 1").select("key", "context"), ["key", "context"], "left_semi").select(*_TEXT, "pos").distinct()
    found = whole.select(*_TEXT, *_unpacked()[1:])
    common.remove(spark, many_path)
    paths = [occ_path, different_path, path]
    for width in (16, 1, 0):
        sizes, sizes_path = common.written(_shared(contexts), "gram-sizes")
        small = contexts.join(sizes.filter(F.col("m") <= limit), "key", "left_semi")
        found = found.unionByName(_sorted_buckets(small, length))
        paths.append(sizes_path)
        large = sizes.filter(F.col("m") > limit).select("key")
        if not width or large.isEmpty():
            break
        rest, rest_path = common.written(_split(contexts.join(large, "key", "left_semi"), width, length), "split", "zstd")
        twice = rest.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(F.struct(*_TEXT, "first")).alias("o"))
        found = found.unionByName(rest.join(twice.filter("n > 1").select("key", "context"), ["key", "context"], "left_semi").select(*_TEXT, "first", "last"))
        one = twice.select("key", "context", "o.*")
        contexts, path = common.written(rest.join(one, ["key", "context", *_TEXT, "first"], "left_semi"), "context-bytes", "zstd")
        paths += [rest_path, path]
    return found, paths


def _merged(found: DataFrame, length: int) -> DataFrame:
    """(text_key, size, spans): the maximal spans of each text, packed as pairs of 32-bit integers."""
    rows = found.select(*_TEXT, "first", "last").repartition(*_TEXT).sortWithinPartitions(*_TEXT, "first")

    def run(batches):
        held: list[tuple[int, int]] = []
        of = None

        def batch_of(out):
            keys, sizes, spans = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(spans, pa.binary())], [*_TEXT, "spans"])

        for batch in batches:
            out = []
            for key, size, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, size) != of:
                    if held:
                        out.append((*of, np.array(held, "<i4").tobytes()))
                    held, of = [], (key, size)
                if held and a <= held[-1][1]:
                    if b + length > held[-1][1]:
                        held[-1] = (held[-1][0], b + length)
                else:
                    held.append((a, b + length))
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([(*of, np.array(held, "<i4").tobytes())])

    return rows.mapInArrow(common.lean(run), "text_key bigint, size int, spans binary")


def _with_spans(docs: DataFrame, text: str, length: int, columns: list[str], found: tuple[DataFrame, list[str]]) -> DataFrame:
    """The columns, _text and _spans. The columns may have any names: they are kept by their places."""
    merged, _ = common.written(_merged(found[0], length), "spans")
    common.remove(docs.sparkSession, *found[1])
    own = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), common.text_of(text).alias("_text"))
    own = own.select("*", *(k.alias(f"_{c}") for k, c in zip(_text_key("_text"), _TEXT, strict=True)))
    joined = own.join(merged.toDF("_text_key", "_size", "_spans"), ["_text_key", "_size"], "left")
    return joined.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)), "_text", "_spans")


def _each(batch) -> list[tuple[bytes, list[list[int]]]]:
    n = batch.num_columns
    return [(t.encode(), np.frombuffer(x or b"", "<i4").reshape(-1, 2).tolist()) for t, x in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True)]


def deduplicated(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans (byte offsets)."""
    names = [f"c{i}" for i in range(len(keep))]
    own = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.col("text").alias("_of"))
    rows = _with_spans(own, "_of", length, names, repeated_windows(docs, length, limit))
    schema = rows.drop("_text", "_spans").selectExpr("*", "0L n_bytes", "0L n_removed", "0L n_spans", "'' kept_sha256", "cast(array() as array<struct<start:int,end:int>>) spans").schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            out = []
            for data, cuts in _each(batch):
                h, at = hashlib.sha256(), 0
                for a, b in cuts:
                    h.update(data[at:a])
                    at = b
                h.update(data[at:])
                out.append((len(data), sum(b - a for a, b in cuts), len(cuts), h.hexdigest(), [{"start": a, "end": b} for a, b in cuts]))
            if out:
                cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64()] * 3 + [pa.string(), kind], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *cols], schema.names)

    return rows.mapInArrow(common.lean(run), schema).toDF(*keep, *schema.names[len(names) :])


def cut_texts(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """The documents without their repeated passages, all columns kept, n_chars brought up to date. A span that ends
    inside a character ends before it. Documents of which only white space is left go, if something was removed."""
    own = common.Shielded(docs)
    text, others = own("text"), [c for c in own.inner.columns if c != own("text")]
    marked = own.inner.withColumn("_null", F.col(text).isNull())
    rows = _with_spans(marked, text, length, [*others, "_null"], repeated_windows(docs, length, limit))
    schema = rows.drop("_text", "_spans").withColumn(text, F.lit("")).withColumn("_cut", F.lit(False)).schema

    def whole(data: bytes, at: int) -> int:
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return at

    def run(batches):
        for batch in batches:
            texts, cut = [], []
            for data, cuts in _each(batch):
                out, at = [], 0
                for a, b in cuts:
                    while a < len(data) and data[a] & 0xC0 == 0x80:
                        a += 1
                    out.append(data[at:a])
                    at = max(a, whole(data, b))
                out.append(data[at:])
                texts.append(b"".join(out).decode())
                cut.append(bool(cuts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(cut)], schema.names)

    got = rows.mapInArrow(common.lean(run), schema).filter(~F.col("_cut") | (F.trim(F.regexp_replace(text, r"\s+", " ")) != ""))
    if "n_chars" in own.names:
        n = own("n_chars")
        got = got.withColumn(n, F.when(F.col("_cut"), F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(n)))
    return own.restore(got.withColumn(text, F.when(~F.col("_null"), F.col(text))))
