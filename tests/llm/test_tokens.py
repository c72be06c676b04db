"""Encoding, counting and storing token ids, against the tokenizers library on whole texts."""

import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pytest

from folioflow.llm import bpe_text, fst_bpe, length_hist, queries, rans

ODD = [
    None, "", " ", "\n", "a", "aaaa" * 3000, "  two  spaces \n\n\n end ", "it's we'll I'D 'tis", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "<|endof", "x²½Ⅷ٣४", "\x1c\x1d \x85 z\x00\x7f",
    "日本語テキスト、漢字", "naïve café ñandú", "é̀ ‍👩‍👩‍👧 😀😀", "१२३ 一二三", "_a_b__ --- ___", "�\U0010ffff\U000e0001", "a\tb\r\nc", "    indented\n\tcode()", "ÀÈÌ" * 500, "1234567890" * 200,
]


def whole(text):
    return bpe_text.library(bpe_text.default_path()).encode(text or "", add_special_tokens=False).ids


def expected(text):
    ids = whole(text)
    back = bpe_text.library(bpe_text.default_path()).decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "clash", 1, "f") for i, t in enumerate(ODD)] + [(None, "null id", "en", None, None, None), (3, "\n", None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string, n_tokens int, part string")


def test_the_quick_split_agrees_on_every_plain_character():
    split = bpe_text._library_split()
    plain = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and bpe_text._PLAIN.fullmatch(chr(c))]
    assert len(plain) > 20000
    for c in plain:
        for t in (f"a{c}b", f"1{c}2", f"!{c}!", f" {c}{c} x", f"{c}\n"):
            assert bpe_text._QUICK.findall(t) == [t[a:b] for _, (a, b) in split.pre_tokenize_str(t)]


def test_pieces_of_random_texts():
    r = random.Random(1)
    path = bpe_text.default_path()
    for _ in range(1500):
        t = "".join(r.choice("aé'sSt 19²\n\t_-.!😀٣ \x1c") if r.random() < 0.9 else chr(r.choice([r.randrange(0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(r.randrange(40)))
        got = bpe_text.pieces(t, path)
        assert "".join(got) == t
        assert list(np.frombuffer(bpe_text.encode(t, path), "<u4")) == whole(t)


def test_merging_is_exact():
    m = fst_bpe.merges(bpe_text.default_path())
    r = random.Random(2)
    for n in [1, 2, 3, 8, 30, 47, 48, 49, 60, 400]:
        for _ in range(20):
            t = "".join(r.choice("aabethionsr") for _ in range(n))
            assert m.merge(t.encode()) == whole(t) == m._merge_long([m.byte[b] for b in t.encode()])


def test_the_lexicon_is_minimal_and_exact(tmp_path):
    words = {f"{a}{b}{c}": None for a in ("", "un", "re") for b in ("do", "tie", "lock") for c in ("", "s", "ing", "ed")}
    entries = {w.encode(): [zlib.crc32(w.encode()) & 0xFFFF, len(w)] for w in words} | {b"\xff\x00": []}
    (tmp_path / "x").write_bytes(fst_bpe.compile_lexicon(entries))
    lex = fst_bpe.Lexicon(str(tmp_path / "x"))
    for w, ids in entries.items():
        assert lex.get(w) == np.array(ids, "<u4").tobytes()
    for w in (b"", b"u", b"undoe", b"unlockin", b"zzz", b"\xff"):
        assert lex.get(w) is None

    def right(w):  # states of the minimal automaton: distinct sets of tails
        return frozenset(x[len(w):] for x in entries if x.startswith(w))

    assert lex.n_states == len({right(w[:i]) for w in entries for i in range(len(w) + 1)})
    (tmp_path / "y").write_bytes(fst_bpe.compile_lexicon({}))
    assert fst_bpe.Lexicon(str(tmp_path / "y")).get(b"a") is None


@pytest.mark.parametrize("size", [0, 40])
def test_encode_decode_of_odd_texts(spark, odd, size):
    lexicon = fst_bpe.build_lexicon(odd, most=size)
    got = {(r["doc_id"], r["ids_sha256"]): r for r in fst_bpe.encode_decode(odd, lexicon, full=True).collect()}
    assert len(got) == len(ODD) + 1
    for doc_id, text in [*enumerate(ODD), (None, "null id")]:
        n, a, b = expected(text)
        r = got[doc_id, a]
        assert (r["n_tokens"], r["decoded_sha256"], r["decoded"], list(r["ids"])) == (n, b, text or "", whole(text))


def test_op3_on_the_table(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op3_transducer_bpe"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == {k: expected(t) for k, t in texts.items()}


def test_histogram_against_brute_force(spark, odd):
    lens = sorted(len(whole(t)) for t in [*ODD, "null id", "\n"])
    hist = length_hist.histogram(length_hist.token_counts(odd))
    rows = {r["length"]: r for r in hist.collect()}
    assert sorted(rows) == sorted(set(lens))
    for c, r in rows.items():
        assert (r["n_docs"], r["docs_from"], r["tokens_from"]) == (lens.count(c), sum(x >= c for x in lens), sum(x for x in lens if x >= c))
        assert (r["truncated_total"], r["docs_total"], r["tokens_total"]) == (sum(min(x, c) for x in lens), len(lens), sum(lens))
        assert r["share_below"] == sum(x < c for x in lens) / len(lens)
    for r in length_hist.at_limits(hist, [0, 5, 100, 10**6]).collect():
        c = r["context_limit"]
        assert (r["docs_over"], r["tokens_kept"]) == (sum(x > c for x in lens), sum(min(x, c) for x in lens))
    for r in length_hist.quantiles(hist, [0.0, 0.5, 0.9]).collect():
        assert r["length"] == lens[int(r["q"] * len(lens))]


def test_op5_on_the_table(spark, sf):
    lens = [len(whole(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for r in queries.QUERIES["op5_length_histogram"](spark, sf).collect():
        assert (r["n_docs"], r["truncated_total"]) == (lens.count(r["length"]), sum(min(x, r["length"]) for x in lens))


def test_empty_tables(spark, odd):
    none = odd.filter("1 = 0")
    assert fst_bpe.encode_decode(none, fst_bpe.build_lexicon(none)).count() == 0
    assert length_hist.histogram(length_hist.token_counts(none)).count() == 0
    assert rans.token_files(none).count() == 0


def test_coder_round_trip_and_damage():
    r = np.random.default_rng(0)
    for n, vocab in [(0, 5), (1, 1), (7, 3), (70_000, 50_000), (300_000, 300)]:
        ids = (r.zipf(1.3, n) % vocab).astype(np.uint32)
        table = rans.Table(rans.normalised(np.bincount(ids, minlength=vocab)))
        assert table.freq.sum() in (0, 1 << rans.SCALE)
        data = rans.pack([1, None], np.array([n, 0]), ids, table)
        got = rans.unpack(data, table)
        assert got[0] == [1, None] and (got[2] == ids).all()
        if n > 100:
            bad = bytearray(data)
            bad[len(bad) // 2] ^= 1
            with pytest.raises(ValueError):
                rans.unpack(bytes(bad), table)
    lanes = 64
    words, states, marks = rans.encode(ids, table, lanes)
    assert len(marks) > 3
    t, at, s = marks[2]  # a second reader starts in the middle
    assert (rans.decode(words, s, len(ids), table, t, at) == ids[t * lanes :]).all()
    assert len(words) * 4 < 1.02 * 300_000 / 8 * -(np.bincount(ids) / 3e5 * np.log2(np.maximum(np.bincount(ids), 1) / 3e5)).sum() + 8 * lanes


@pytest.mark.parametrize("block", [1, 500, 1 << 20])
def test_files_of_odd_texts(spark, odd, block):
    got = rans.token_files(odd, block_ids=block).orderBy("start").collect()
    want = [(None, [*whole("null id"), 2])] + [(i, [*whole(t), 2]) for i, t in enumerate(ODD)]
    want.insert(5, (3, [*whole("\n"), 2]))
    at = 0
    assert len(got) == len(want)
    for r, (doc_id, ids) in zip(got, want, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op10_on_the_table(spark, sf):
    at = 0
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_rans_token_files"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*whole(r["text"]), 2]
        assert (got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_unicode_data_is_there():
    assert unicodedata.category("²") == "No"
