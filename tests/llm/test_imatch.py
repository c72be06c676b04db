import hashlib
import random
import re
from collections import Counter

import xxhash

from folioflow.llm import imatch, queries

BITS = imatch


def edits(rows):
    """doc_id -> (n_chars, hash of the edited text, next text), rows sorted as the operator sorts them."""
    rows = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(1 << 63)))
    out = []
    for i, (d, t) in enumerate(rows):
        t = t or ""
        following = rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits_over_blocks(spark):
    ids = [0, 1, 255, 256, 257, 5000, 70000, 1 << 21, (1 << 21) + 1, 1 << 40, -7, -300, None]
    rows = [(d, None if i == 3 else "" if i == 5 else f"tëxt 😀 {d} " * (i + 1)) for i, d in enumerate(ids)]
    df = spark.createDataFrame([(*r, 1, "") for r in rows], "doc_id long, text string, block int, h string")
    got = imatch.against_edits(df).collect()
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=str) == edits(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_single_empty_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert imatch.against_edits(spark.createDataFrame([], schema)).count() == 0
    one = imatch.against_edits(spark.createDataFrame([(4, "abcdef")], schema)).collect()
    assert [(r["n_chars"], r["edited_sha256"], r["near_next"]) for r in one] == [(6, hashlib.sha256(b"abcdab").hexdigest(), 1.0)]
    rows = [(4, "same"), (4, "same"), (4, "same"), (4, "other")]
    got = imatch.against_edits(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r["n_chars"] for r in got) == [4, 4, 4, 5]


def plain_fingerprint(text, band):
    """The fingerprint in plain Python: XXH64 with the seed 42, as Spark has it, folded over sorted terms."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    terms = sorted({signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words_of(text)})
    known = [t for t in terms if t in band]
    out = []
    for i, parts in enumerate(imatch.PARTS):
        for s in range(imatch.USED):
            h, some = 42, False
            for t in known:
                if (t >> (14 + 12 * i)) % parts == s:
                    h, some = xxhash.xxh64_intdigest(t.to_bytes(8, "little", signed=True), h), True
            out.append(f"{h & 0xFFFF:04x}" if some else "----")
    return out


def plain_likeness(a, b, same):
    if same or (a == b and set(a) != {"----"}):
        return 1.0
    best = 0.0
    for i in range(len(imatch.PARTS)):
        pairs = [(x, y) for x, y in zip(a[16 * i : 16 * i + 16], b[16 * i : 16 * i + 16], strict=True) if (x, y) != ("----", "----")]
        best = max(best, sum(x == y for x, y in pairs) / max(imatch.ENOUGH, len(pairs)))
    return best


def words_of(text):
    return {w for w in re.split(r"[^\w]+|_", text.lower()) if w}


def test_fingerprints_against_python(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    df = Counter(w for t in set(texts.values()) for w in words_of(t))
    n = len(set(texts.values()))
    band = {w for w, k in df.items() if max(2, -(-n // 256)) <= k <= max(2, n * imatch.CEILING)}
    lex = {r["t"] for r in imatch.lexicon(docs).collect()}
    assert len(lex) == len(band)
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_imatch_fingerprints"](spark, sf).collect()}
    assert set(got) == set(texts)
    order = sorted(texts, reverse=True)
    prints = {d: plain_fingerprint(t, lex) for d, t in texts.items()}
    for d, after in zip(order, order[1:] + order[:1], strict=True):
        r, t = got[d], texts[d]
        k = len(t) // 3
        edited = t[: len(t) - k] + texts[after][:k]
        own = plain_fingerprint(edited, lex)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == ("".join(prints[d]), "".join(own))
        assert abs(r["near_edited"] - plain_likeness(prints[d], own, t == edited)) < 1e-12
        assert abs(r["near_next"] - plain_likeness(prints[d], prints[after], t == texts[after])) < 1e-12
    rows = list(got.values())
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.9 * len(rows)
    print("near_edited", sum(r["near_edited"] for r in rows) / len(rows), "near_next", sum(r["near_next"] for r in rows) / len(rows))


def test_copies_do_not_push_their_terms_out_of_the_band(spark):
    r = random.Random(1)
    prose = lambda: " ".join(f"w{r.randrange(400)}" for _ in range(40))
    hot = prose()
    rows = [(i, hot if i % 3 == 0 else prose()) for i in range(300)]
    got = {x["doc_id"]: x for x in imatch.against_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len({got[i]["fingerprint"] for i in range(0, 300, 3)}) == 1
    assert len({x["fingerprint"] for x in got.values()}) == 201
    assert sum(got[i]["near_edited"] for i in range(0, 300, 3)) / 100 > 0.2


def test_texts_without_a_term_of_the_band(spark):
    rows = [(i, " ".join(f"only{i}x{j}" for j in range(60))) for i in range(50)] + [(90, "?!"), (91, "..."), (92, ""), (93, "")]
    got = {x["doc_id"]: x for x in imatch.against_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {x["fingerprint"] for x in got.values()} == {"----" * 48}
    assert all(got[i]["near_next"] == 0.0 for i in (*range(50), 90, 91, 92)) and got[93]["near_next"] == 1.0  # only equal texts are alike
    assert all(got[i]["near_edited"] == 0.0 for i in range(50)) and got[93]["near_edited"] == 1.0


def test_few_terms_of_the_band_tell_a_text(spark):
    rows = [(2 * i + k, f"shared{i} " + " ".join(f"only{i}x{k}x{j}" for j in range(20))) for i in range(40) for k in range(2)]
    got = {x["doc_id"]: x for x in imatch.against_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(40):
        assert got[2 * i]["fingerprint"] == got[2 * i + 1]["fingerprint"]
        some = got[2 * i]["fingerprint"] != "----" * 48  # its term falls into a used subset
        assert got[2 * i + 1]["near_next"] == (1.0 if some else 0.0)


def test_repeated_null_and_hashed_ids(spark, monkeypatch):
    monkeypatch.setattr(imatch, "_HOT", 5)
    monkeypatch.setattr(imatch, "MOST_TERMS", 0)  # the lexicon is joined by a shuffle
    r = random.Random(4)
    rows = [(d, f"text {i % 37} of {d} " * 5) for i in range(120) for d in (None, 7, r.getrandbits(63) - (1 << 62))]
    got = imatch.against_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((x["doc_id"], x["n_chars"]) for x in got) == Counter((d, len(t)) for d, t in rows)
    texts, ids = {}, sorted({d if d is not None else -(1 << 63) for d, _ in rows}, reverse=True)
    for d, t in rows:
        texts.setdefault(d if d is not None else -(1 << 63), []).append(t)
    following = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    for x in got:  # the next text is one of the same id or one of the next id
        d = x["doc_id"] if x["doc_id"] is not None else -(1 << 63)
        own = [t for t in texts[d] if len(t) == x["n_chars"]]
        possible = {hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest() for t in own for n in texts[d] + texts[following[d]]}
        assert x["edited_sha256"] in possible


def test_likeness_of_equal_and_disjoint(spark):
    full, none = list(range(16)), [-1] * 16
    half = [*range(8), *range(20, 28)]
    rows = [(full * 3, half + none * 2), (none * 3, none * 3), ([1] + none[1:] + none * 2, [1, 2] + none[2:] + none * 2), (full * 3, [50] * 48)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>")
    assert [r[0] for r in df.select(imatch.likeness(df["a"], df["b"])).collect()] == [0.5, 0.0, 0.25, 0.0]
