"""Chunk tables of many and of long texts: one pass, no shuffle, bounded batches; headings against plain Python."""

import random
import re

from folioflow.operators import chunks, documents, headings


def _docs(spark, rows):
    return spark.createDataFrame(rows, "accession string, cik string, company string, form string, filed date, text string, blocks array<struct<kind:string,start:int,end:int>>")


def test_texts_are_cut_without_a_shuffle(spark):
    docs = _docs(spark, [("a", "1", "x", "10-K", None, "Item 1. One\n" + "word " * 300, None)])
    assert "Exchange" not in chunks.assembled(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in headings.item_regions(docs, "accession")._jdf.queryExecution().executedPlan().toString()


def test_batches_of_chunks_are_bounded():
    rows = [{"accession": str(i), "cik": None, "company": None, "form": "10-K", "filed": None, "text": "some words here. " * 30000, "blocks": None, "regions": None} for i in range(20)]
    got = list(chunks._cut(rows, 512, 64, 32))
    assert len(got) >= 8 and max(b.nbytes for b in got) < 2 * chunks.CHARS
    assert sum(b.num_rows for b in got) == 20 * len(documents.windows(rows[0]["text"]))


def test_a_repeated_accession_has_the_items_of_its_own_text(spark):
    docs = _docs(spark, [("a", "1", "x", "10-K", None, f"Item {n}. Title\n" + "word " * 60, None) for n in (1, 2)] + [(None, "1", "x", "10-K", None, "word " * 60, None)])
    assert sorted(r.item_number for r in chunks.assembled(docs, 512, 64, 32).collect()) == ["1", "2"]


def test_words_are_those_of_the_expression():
    rnd = random.Random(4)
    assert not any(chr(i).isspace() for i in range(len(documents._BLANK), 0x110000))
    for n in [0, 1, 2, *range(3, 60)]:
        text = "".join(rnd.choice([" ", "\n", "　", " ", "\x1c", "​", "a", "é", "😀", "漢"]) for _ in range(n))
        words = documents._Words(text)
        assert list(zip(words.begin.tolist(), words.end.tolist(), strict=True)) == [m.span() for m in re.finditer(r"\S+", text)]


def _plain(text):
    at, best, kept = 0, None, []
    for line in text.split("\n"):
        if re.match(r"(?i)[ \t]*PART[ \t]+[IVX]{1,4}\b", line):
            best = None
        elif m := re.match(r"(?i)[ \t]*Item[ \t]+([0-9]{1,2})([A-C]?)[.:]+", line):
            order = (int(m[1]), m[2].upper())
            if best is None or order > best:
                best = order
                kept.append((at, m[1] + m[2].upper()))
        at += len(line) + 1
    return [(a, b, item) for (a, item), b in zip(kept, [a for a, _ in kept[1:]] + [len(text)], strict=False)]


def test_regions_against_plain_python(spark):
    rnd = random.Random(8)
    line = lambda: rnd.choice(["", "text é😀", "see Item 9. there", "PART II", " part x", "PARTS", f"Item {rnd.randrange(1, 17)}{rnd.choice(['', 'A', 'b'])}. Title", "item 3: ", "Item 4"])
    texts = ["\n".join(line() for _ in range(rnd.randrange(25))) for _ in range(150)]
    rows = spark.createDataFrame([(i, "10-K", t) for i, t in enumerate([*texts, None])], "doc_id long, form string, text string")
    got = sorted((r.doc_id, r.start, r.end, r.item) for r in headings.item_regions(rows).collect())
    assert got == sorted((i, *x) for i, t in enumerate(texts) for x in _plain(t))
