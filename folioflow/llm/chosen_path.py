"""Jaccard join of word shingles by chosen paths: near duplicates with a similarity of 0.8 or more over five words.

Each run sends a set down a path: at every step the set chooses, by a hash seeded with the path so far, one of its own
shingles, so that two sets of similarity J choose alike with probability J. Sets that share a path meet in a bucket.
A bucket with more than LIMIT sets is split by the next step, at most DEPTH steps deep; small buckets are compared
pair by pair; what is still large after the last step is compared in blocks, each pair of blocks a bucket of its own,
so no bucket is cut short. Runs go in rounds of RUNS, which are repeated until the target recall: of the links found
first in a round, those that met in one run only and those that met in two tell how many links have met in none
(Chao's estimate, which may be too small where links differ much in how easily they meet). One round brings the recall
of a pair at 0.8 to 1 - 0.2**8 in buckets that are not split, and to 0.997 in those split twice. A pair is judged in
the first run in which it meets.

Comparing has two steps: sketches (128 small hashes) and sizes leave the plausible pairs; then the buckets in which
these are get the whole shingle sets, and similarities are exact.
Documents with equal shingle sets are one node with a weight; classes are connected components of the links.

Words are split at white space, in lower case. A text of fewer than five words is one shingle.
Defined cases: null and empty texts have no shingle, and are copies of each other; repeated rows are copies; a null
doc_id takes part like any other, and a class of null ids only has a null class_id; of equal ids in a class the smallest
text hash comes first; a text of any length is one set; no rows give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, SIMILARITY = 5, 0.8
RUNS, DEPTH, LIMIT = 8, 3, 1024
#: Share of the links to be found, as estimated after each round.
TARGET = 0.99
BINS = 128
#: Sketches tell the similarity to about 0.035; pairs that look less alike than this are 0.8 or more once in 10**8.
PLAUSIBLE = SIMILARITY - 0.2

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word -> 64-bit hash. Bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        got = xxhash.xxh64_intdigest(word.encode())
        if len(word) <= 64:
            self[word] = got
        return got


def shingles(text: str, words: Words, size: int = WORDS) -> np.ndarray:
    """The set of hashed shingles, ascending."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(size, len(h))):
        out = mix(out + h[i : i + n] + np.uint64(i))
    return np.unique(out)


def paths(s: np.ndarray, first: int = 0) -> np.ndarray:
    """DEPTH x RUNS path hashes of a set, for the runs from `first` on."""
    out = np.zeros((DEPTH, RUNS), np.uint64)
    seed = mix(np.arange(first + 1, first + RUNS + 1, dtype=np.uint64))
    for d in range(DEPTH):
        best = s[np.argmin(mix(s[None, :] ^ seed[:, None]), axis=1)]
        seed = out[d] = mix(seed + mix(best)) | np.uint64(1)
    return out


def sketch(s: np.ndarray) -> np.ndarray:
    """The low byte of the smallest hash in each of BINS stretches of the hash space; 0: none."""
    m = np.sort(mix(s ^ np.uint64(0xA5A5A5A5)))
    shift = np.uint64(64 - BINS.bit_length() + 1)
    bins = (m >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out = np.zeros(BINS, np.uint8)
    out[bins[first]] = (m[first] & np.uint64(0xFF)).astype(np.uint8) | np.uint8(1)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


_OF_SETS = "doc_id bigint, text_key bigint, set_key bigint, n int, paths array<array<bigint>>, sketch binary"


def described(docs: DataFrame) -> DataFrame:
    """For each row its text's hash, its set's hash and size, its paths and its sketch."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text")).withColumn("text_key", F.xxhash64("text")).select("doc_id", "text_key", "text")

    def run(batches):
        words = Words()
        for batch in batches:
            keys, sizes, ways, marks = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingles(text, words)
                keys.append(xxhash.xxh64_intdigest(s.tobytes()))
                sizes.append(len(s))
                ways.append([_signed(p).tolist() for p in paths(s)] if len(s) else None)
                marks.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(_signed(np.array(keys, np.uint64))), pa.array(sizes, pa.int32()), pa.array(ways, pa.list_(pa.list_(pa.int64()))), pa.array(marks, pa.binary())],
                ["doc_id", "text_key", "set_key", "n", "paths", "sketch"],
            )

    return own.mapInArrow(common.lean(run), _OF_SETS)


def _leaves(nodes: DataFrame, limit: int) -> DataFrame:
    """(set_key, leaves, met): for each run the hash of the bucket where the set ends, 0 where it is alone; and for the
    runs with company the bucket, its size and the run."""
    at = nodes.select("set_key", F.posexplode(F.arrays_zip(*(F.col("paths")[d].alias(f"p{d}") for d in range(DEPTH)))).alias("run", "z")).select("set_key", "run", "z.*")
    ended, going = None, at
    for d in range(DEPTH):
        sizes = going.groupBy(f"p{d}").agg(F.count("*").alias("size")).filter("size > 1")
        going = going.join(sizes, f"p{d}")
        done = going if d == DEPTH - 1 else going.filter(F.col("size") <= limit)
        done = done.select("set_key", "run", F.col(f"p{d}").alias("leaf"), "size")
        ended = done if ended is None else ended.unionByName(done)
        going = going.filter(F.col("size") > limit).drop("size")
    ended, _ = common.written(ended, "leaves")
    every = F.transform(F.sequence(F.lit(0), F.lit(RUNS - 1)), lambda r: F.coalesce(F.try_element_at(F.col("m"), r), F.lit(0).cast("bigint")))
    got = ended.groupBy("set_key").agg(F.map_from_entries(F.collect_list(F.struct("run", "leaf"))).alias("m"), F.collect_list(F.struct("run", "leaf", "size")).alias("met"))
    return got.select("set_key", every.alias("leaves"), "met")


_MEMBER = "cell long, chunk int, whole boolean, run int, set_key long, n int, leaves array<bigint>, sketch binary, doc_id long, text_key long, copies long"


def _cells(nodes: DataFrame, leaves: DataFrame, limit: int) -> DataFrame:
    """A row for each set and bucket. Buckets over the limit become pairs of blocks (cells): a block has about half the
    limit, is chosen by the set's hash, and meets each block once; chunk tells the block."""
    rows = nodes.join(leaves, "set_key").select("*", F.explode("met").alias("b")).select("*", "b.run", "b.leaf", "b.size").drop("b", "met", "paths")
    small = rows.filter(F.col("size") <= limit).select(F.col("leaf").alias("cell"), F.lit(0).alias("chunk"), F.lit(True).alias("whole"), *_MEMBERS)
    g = F.ceil(F.col("size") / max(1, limit // 2)).cast("int")
    large = rows.filter(F.col("size") > limit).withColumn("g", g).withColumn("chunk", F.pmod(F.xxhash64("set_key", F.lit(7)), F.col("g")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    a, b = F.least("chunk", "other"), F.greatest("chunk", "other")
    large = large.select(F.xxhash64("leaf", a, b).alias("cell"), "chunk", (F.col("chunk") == F.col("other")).alias("whole"), *_MEMBERS)
    return small.unionByName(large)


_MEMBERS = ["run", "set_key", "n", "leaves", "sketch", "doc_id", "text_key", "copies"]


class Members:
    """Rows of one Arrow table as arrays."""

    def __init__(self, t: pa.Table):
        self.cell, self.chunk = t["cell"].to_numpy(), t["chunk"].to_numpy()
        self.whole = t["whole"].to_numpy(zero_copy_only=False).astype(bool)
        self.run, self.key, self.n = t["run"].to_numpy(), t["set_key"].to_numpy(), t["n"].to_numpy()
        self.leaves = np.array(t["leaves"].combine_chunks().flatten(), np.int64).reshape(len(t), -1)
        self.sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(t), BINS)

    def meetings(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of runs in which the rows of each pair share a bucket."""
        return np.count_nonzero((self.leaves[i] == self.leaves[j]) & (self.leaves[i] != 0), axis=1)

    def plausible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of rows are to be judged here and may be similar enough."""
        ok = self.key[i] != self.key[j]
        ok &= self.whole[i] | (self.chunk[i] != self.chunk[j])
        ok &= np.minimum(self.n[i], self.n[j]) >= SIMILARITY * np.maximum(self.n[i], self.n[j]) - 1e-9
        i, j = i[ok], j[ok]
        same = (self.leaves[i] == self.leaves[j]) & (self.leaves[i] != 0)
        first = np.argmax(same, axis=1) == self.run[i]
        left = np.flatnonzero(ok)[first]
        i, j = i[first], j[first]
        a, b = self.sketch[i], self.sketch[j]
        some = np.count_nonzero(a | b, axis=1)
        alike = np.count_nonzero((a == b) & (a > 0), axis=1) >= PLAUSIBLE * some
        out = np.zeros(len(ok), bool)
        out[left[alike]] = True
        return out

    def pairs(self):
        """Plausible pairs of rows of equal cells, in portions; rows are sorted by cell."""
        n = len(self.cell)
        d, i = 1, np.arange(n - 1)
        while len(i):
            i = i[i + d < n]
            i = i[self.cell[i] == self.cell[i + d]]
            for k in range(0, len(i), 1 << 16):
                part = i[k : k + (1 << 16)]
                ok = self.plausible(part, part + d)
                if ok.any():
                    yield part[ok], part[ok] + d
            d += 1


def whole_cells(batches):
    """Tables of complete cells from batches sorted by cell; the last cell of a batch waits for the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        if not len(t):
            continue
        cell = t["cell"].to_numpy()
        cut = int(np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))[-1])
        held = t.slice(cut)
        if cut:
            yield t.slice(0, cut)
    if held is not None and len(held):
        yield held


def _with_company(cells: DataFrame) -> DataFrame:
    """The rows that have a plausible partner in their cell."""
    rows = cells.repartition("cell").sortWithinPartitions("cell")
    names = cells.columns

    def run(batches):
        for t in whole_cells(batches):
            m = Members(t)
            keep = np.zeros(len(t), bool)
            for i, j in m.pairs():
                keep[i] = keep[j] = True
            if keep.any():
                yield from t.filter(pa.array(keep)).combine_chunks().select(names).to_batches()

    return rows.mapInArrow(common.lean(run), cells.schema)


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of the sets of each pair."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common_parts = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, min(8192, (32 << 20) // (4 * len(sets))))
    for at in range(0, int(col[-1]) + 1, width):
        a, b = np.searchsorted(col, [at, at + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[a:b], col[a:b] - at] = 1
        common_parts += m @ m.T
    return common_parts[i, j].astype(np.int64)


_LINKED = ["set_key", "weight", "root", "pairs", "once", "twice"]


def _judge(t: pa.Table) -> list[tuple[int, ...]]:
    """(set, weight of its partners, smallest set of its component, links counted here, those of them that met in one
    run, in two) for the linked sets of the cells of t."""
    m = Members(t)
    keys, copies = m.key, t["copies"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
    found = list(m.pairs())
    if not found:
        return []
    i, j = (np.concatenate([p[k] for p in found]) for k in (0, 1))
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    out = []
    starts = np.flatnonzero(np.concatenate([[True], m.cell[1:] != m.cell[:-1]]))
    ends = np.append(starts[1:], len(m.cell))
    cuts = np.searchsorted(i, np.append(starts, len(m.cell)))
    for s, e, a, b in zip(starts.tolist(), ends.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a == b:
            continue
        x, y = i[a:b], j[a:b]
        both = overlaps(sets[s:e], x - s, y - s)
        ok = both >= SIMILARITY * (m.n[x] + m.n[y] - both) - 1e-9
        x, y = x[ok], y[ok]
        if not len(x):
            continue
        weight = np.bincount(x - s, copies[y], e - s) + np.bincount(y - s, copies[x], e - s)
        met = m.meetings(x, y)
        counts = [np.bincount(x[k] - s, minlength=e - s) for k in (met > 0, met == 1, met == 2)]
        root = list(range(e - s))

        def top(v: int, root=root) -> int:
            while root[v] != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        for u, v in zip((x - s).tolist(), (y - s).tolist(), strict=True):
            u, v = top(u), top(v)
            if u != v:
                if keys[s + u] > keys[s + v]:
                    u, v = v, u
                root[v] = u
        out += [(int(keys[s + v]), int(weight[v]), int(keys[s + top(v)]), *(int(c[v]) for c in counts)) for v in np.flatnonzero(weight).tolist()]
    return out


def _links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The columns _LINKED for every cell and linked set in it, similarities exact."""
    spark = docs.sparkSession
    least = F.lit(-(1 << 63)).cast("bigint")
    asked = members.groupBy("set_key", F.coalesce("doc_id", least).alias("_id"), "text_key").agg(F.collect_list(F.struct("cell", "chunk", "whole", *_MEMBERS)).alias("m"))
    own = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), least).alias("_id"), common.text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))
    rows = own.join(asked, ["_id", "text_key"]).select("set_key", "text", "m")

    def sets(batches):
        words = Words()
        for batch in batches:
            for piece in [batch.slice(k, 64) for k in range(0, len(batch), 64)]:
                s = pa.array([shingles(t, words).tobytes() for t in piece.column(1).to_pylist()], pa.binary())
                each = piece.column(2)
                flat = each.flatten()
                of = np.repeat(np.arange(len(piece)), np.array(each.value_lengths()))
                yield pa.RecordBatch.from_arrays([*flat.flatten(), s.take(pa.array(of))], [*(f.name for f in flat.type), "shingles"])

    schema = members.select("cell", "chunk", "whole", *_MEMBERS).withColumn("shingles", F.lit(b"")).schema
    dealt = rows.mapInArrow(common.lean(sets), schema).repartition("cell").sortWithinPartitions("cell", "set_key")

    def run(batches):
        for t in whole_cells(batches):
            cell, key = t["cell"].to_numpy(), t["set_key"].to_numpy()
            new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (key[1:] != key[:-1])])  # a repeated row counts once
            out = _judge(t.filter(pa.array(new)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], _LINKED)

    return dealt.mapInArrow(common.lean(run), ", ".join(f"{c} bigint" for c in _LINKED))


def _with_paths(docs: DataFrame, nodes: DataFrame, first: int) -> DataFrame:
    """The nodes with their paths of the runs from `first` on, each from one of its texts."""
    least = F.lit(-(1 << 63)).cast("bigint")
    own = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), least).alias("_id"), common.text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))
    rows = own.join(nodes.select(F.coalesce("doc_id", least).alias("_id"), "text_key", "set_key"), ["_id", "text_key"]).select("set_key", "text")

    def run(batches):
        words = Words()
        for batch in batches:
            ways = [[_signed(p).tolist() for p in paths(shingles(t, words), first)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ways, pa.list_(pa.list_(pa.int64())))], ["set_key", "paths"])

    new = rows.mapInArrow(common.lean(run), "set_key bigint, paths array<array<bigint>>").groupBy("set_key").agg(F.any_value("paths").alias("paths"))
    return nodes.drop("paths").join(new, "set_key")


def unseen(once: int, twice: int) -> float:
    """Estimated number of links that met in no run of a round, from those that met in one and in two of its runs."""
    return (RUNS - 1) / RUNS * once * (once - 1) / (2 * (twice + 1))


def links_until(docs: DataFrame, nodes: DataFrame, limit: int = LIMIT, target: float = TARGET) -> tuple[DataFrame, list[tuple[int, float]]]:
    """The links of rounds of runs until the estimated recall is at the target, and for each round the links found so
    far and that estimate. Every link counts once, in the round in which it meets first."""
    nodes = nodes.filter("n > 0")
    links, before, found, rounds = None, None, 0, []
    while True:
        first = len(rounds) * RUNS
        leaves = _leaves(_with_paths(docs, nodes, first) if first else nodes, limit)
        if first:
            none = [F.array_repeat(F.lit(0).cast("bigint"), n) for n in (first, RUNS)]
            every = F.concat(F.coalesce("before", none[0]), F.coalesce("leaves", none[1]))
            later = F.transform("met", lambda b: F.struct((b["run"] + first).alias("run"), b["leaf"].alias("leaf"), b["size"].alias("size")))
            leaves = leaves.join(before, "set_key", "full").select("set_key", every.alias("leaves"), later.alias("met"))
        cells = _cells(nodes, leaves, limit).select("cell", "chunk", "whole", *_MEMBERS)
        members, at = common.written(_with_company(cells), "members")
        new, _ = common.written(_links(docs, members), "links")
        common.remove(docs.sparkSession, at)
        links = new if links is None else links.unionByName(new)
        pairs, once, twice = (x or 0 for x in new.agg(F.sum("pairs"), F.sum("once"), F.sum("twice")).first())
        found += pairs
        rest = unseen(once, twice)
        rounds.append((found, found / (found + rest) if rest else 1.0))
        if rounds[-1][1] >= target:
            return links, rounds
        before, _ = common.written(leaves.select("set_key", F.col("leaves").alias("before")), "leaves-before")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the smallest node of its component for every node of the edges (u, v).

    Rounds of stars: a node's larger neighbours, then its smaller ones, are tied to the smallest of all. Rounds stop when
    nothing changes; each is written to the shared folder."""
    spark = edges.sparkSession

    def stars(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both if larger else both.filter("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        tied = both.join(least, "u")
        if larger:
            return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()

    now, path = common.written(edges.select("u", "v").filter("u != v").distinct(), "edges")
    state = None
    while True:
        new, new_path = common.written(stars(stars(now, True), False), "edges")
        seen = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        common.remove(spark, path)
        now, path = new, new_path
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def joined(docs: DataFrame, limit: int = LIMIT, target: float = TARGET) -> DataFrame:
    """One row a document: class_id (smallest doc_id of its class), n_links (other documents with similarity 0.8 or
    more, copies included), n_copies (documents with the same shingle set), text_key (its text's 64-bit hash), root (the
    smallest hash of a shingle set of its class)."""
    spark = docs.sparkSession
    common.ship_code(spark)
    rows, _ = common.written(described(docs), "sets")
    least = F.lit(-(1 << 63)).cast("bigint")
    pick = F.struct(F.coalesce("doc_id", least).alias("k"), "text_key", "doc_id", "n", "paths", "sketch")
    nodes = rows.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.min_by(pick, F.struct("doc_id", "text_key")).alias("p"))
    nodes, _ = common.written(nodes.select("set_key", "first_id", "copies", "p.text_key", "p.doc_id", "p.n", "p.paths", "p.sketch"), "nodes")
    links, _ = links_until(docs, nodes, limit, target)
    comp = components(links.select(F.col("set_key").alias("u"), F.col("root").alias("v")))
    weights = links.groupBy("set_key").agg(F.sum("weight").alias("weight"))
    known = nodes.select("set_key", "first_id", "copies").join(weights, "set_key", "left").join(comp.withColumnRenamed("node", "set_key"), "set_key", "left")
    known = known.withColumn("root", F.coalesce("root", "set_key"))
    ids = known.groupBy("root").agg(F.min("first_id").alias("class_id"))
    known = known.join(ids, "root").select("set_key", "root", "class_id", (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies"))
    known, _ = common.written(known, "classes")
    return rows.select("doc_id", "set_key", "text_key").join(known, "set_key").select("doc_id", "class_id", "n_links", "n_copies", "text_key", "root")


def one_of_each(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The document with the smallest doc_id of each class (of equal ids the smallest text hash; a null id only where the
    class has no other), all its columns; of repeated rows one stays."""
    least = F.lit(-(1 << 63)).cast("bigint")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("m")
    kept = joined(docs, limit).groupBy("root").agg(first).select(F.coalesce("m.doc_id", least).alias("_id"), F.col("m.text_key").alias("_text_key"))
    kept, _ = common.written(kept, "kept")
    own = common.Shielded(docs)
    rows = own.inner.withColumns({"_id": F.coalesce(F.col(own("doc_id")).cast("bigint"), least), "_text_key": F.xxhash64(common.text_of(own("text")))})
    return own.restore(rows.join(kept, ["_id", "_text_key"], "left_semi").dropDuplicates(["_id", "_text_key"]))
