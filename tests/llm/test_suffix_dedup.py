import hashlib
import random
from collections import Counter

import pytest

from folioflow.llm import queries, suffix_dedup as sd


def brute(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept hash) of each text, by a count of all windows."""
    data = [(t or "").encode() for t in texts]
    n = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d) + 1)
        for i in range(len(d) - length + 1):
            if n[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        starts = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(d)))
        out.append((len(d), sum(gone), starts, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))  # noqa: B905
    return out


def digest(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def corpus(seed, docs=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (30, 45, 60, 80, 300)]
    out = [None, "", "a" * 199, "b" * 200, "c" * 201, "xy" * 500, "é" * 150, "é" * 300, prose(2000)]
    for _ in range(docs):
        t = [prose(r.randrange(80))]
        for _ in range(r.randrange(3)):
            s = r.choice(shared)
            a = r.randrange(len(s) // 2)
            t += [s[a : a + r.randrange(len(s))], prose(r.randrange(60))]
        out.append(" ".join(t))
    base = prose(120)
    for _ in range(docs // 2):  # near copies: a few words changed
        w = base.split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = word()
        out.append(" ".join(w))
    return out + out[20:24]


@pytest.mark.parametrize("limit", [2, 5, 256])
def test_against_all_windows(spark, limit):
    texts = corpus(limit)
    df = spark.createDataFrame([(i, t, i, i, "") for i, t in enumerate(texts)], "doc_id long, text string, key int, first int, _text string")
    assert digest(sd.deduplicated(df, limit=limit)) == dict(enumerate(brute(texts)))


def test_long_texts_are_hashed_in_stretches(spark, monkeypatch):
    texts = corpus(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(sd, "STRETCH", 137)
    assert {k for k in digest(sd.deduplicated(df)).items()} == set(enumerate(brute(texts)))


def test_op6_on_the_table(spark, sf):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = digest(queries.QUERIES["op6_suffix_dedup"](spark, sf))
    assert got == dict(zip(rows, brute(list(rows.values())), strict=True))
    assert sum(v[1] for v in got.values()) > 10_000


def test_empty_table_null_ids_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert sd.deduplicated(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "z" * 250), (None, "q" * 150), (4, "ab" * 130), (4, "ab" * 130), (4, "other text")]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in sd.deduplicated(spark.createDataFrame(rows, schema)).collect())
    assert got == [("4", 10, 0), ("4", 260, 260), ("4", 260, 260), ("None", 150, 0), ("None", 250, 250)]


def test_cut_texts_keeps_columns_and_characters(spark):
    passage = "é" * 150
    rows = [(1, "clean start " + passage + "€ end", 500, 1, "x"), (2, passage, 150, 2, "y"), (3, "only clean", 10, 3, None), (4, None, None, 4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, _cut int, _key string")
    got = {r["doc_id"]: tuple(r) for r in sd.cut_texts(df).collect()}
    assert sd.cut_texts(df).columns == df.columns
    assert got == {1: (1, "clean start € end", 17, 1, "x"), 3: rows[2], 4: rows[3]}


def test_deep_shallow_sort():
    r = random.Random(5)
    for _ in range(200):
        n = r.randrange(1, 40)
        strings = [bytes(r.choice(b"ab") for _ in range(r.choice([0, 3, 20, 80]))) for _ in range(n)]
        strings += [s[: r.randrange(len(s) + 1)] for s in strings[: n // 2]] + strings[: n // 3]
        start = r.choice([0, 0, 12])
        strings = [b"p" * start + s for s in strings]
        order, lcp = sd.deep_shallow_sort(strings, shallow=r.choice([0, 1, 4, 48]), start=start)
        assert sorted(order) == list(range(len(strings))) and [strings[i] for i in order] == sorted(strings)
        for k in range(1, len(order)):
            a, b = strings[order[k - 1]], strings[order[k]]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
    m = sd.prefix_matrix([b"aab", b"b", b"aac", b"aab"])
    assert m[0, 2] == 2 and m[0, 3] == 3 and m[1, 2] == 0
