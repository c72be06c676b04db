import base64
import gzip
import hashlib
import random

from folioflow.llm import common, queries, warc

SCHEMA = "page_id long, url string, html string, offset int, sha string"


def roundtrip(spark, rows):
    index, folder = warc.archive(spark.createDataFrame(rows, SCHEMA))
    return index, folder, warc.read_records(index, folder).collect()


def expected(rows):
    out = []
    for page_id, url, html, *_ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        ref = min(same) if same and min(same) != page_id else None
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if ref is None else "revisit", ref, url or ""))
    return sorted(out, key=str)


def test_odd_pages(spark):
    rows = [(5, "http://a/é x", "<p>é</p>\r\n\r\nWARC/1.1\r\n", 1, "x"), (2, None, None, 1, "x"), (9, "u", "", 1, "x"), (7, "u\r\nX: y", "same", 1, "x"), (3, "v", "same", 1, "x"), (3, "v", "same", 1, "x"), (None, "n", "same", 1, "x"), (None, "n", "only null", 1, "x"), (1, "w", "z" * 3_000_000, 1, None)]
    index, folder, got = roundtrip(spark, rows)
    assert index.count() == len(rows)
    assert sorted([tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got], key=str) == sorted([r[:5] for r in expected(rows)], key=str)
    assert {r["url"] for r in got if r["page_id"] == 5} == {"http://a/%C3%A9%20x"}
    some = warc.read_records(index.filter("page_id in (1, 7)"), folder).collect()
    assert sorted(r["page_id"] for r in some) == [1, 7]


def test_hot_payload_and_empty_table(spark):
    r = random.Random(3)
    rows = [(i, f"u{i}", "hot" if i % 3 else f"page {r.random()}", None, None) for i in range(3000)]
    _, _, got = roundtrip(spark, rows)
    assert sorted([tuple(x[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")) for x in got], key=str) == expected(rows)
    assert roundtrip(spark, [])[2] == []


def test_op7_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.QUERIES["op7_warc_index"](spark, sf).collect()
    assert sorted([tuple(x[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for x in got], key=str) == sorted([r[:5] for r in expected(rows)], key=str)


def test_ranges_are_coalesced():
    assert warc.coalesced([(0, 10), (10, 5), (100, 5), (10**6, 5)], most=1000, gap=100) == [(0, 3, 105), (3, 4, 10**6 + 5)]
    assert warc.coalesced([(0, 600), (600, 600)], most=1000) == [(0, 1, 600), (1, 2, 1200)]
    assert warc.coalesced([]) == []


def test_the_archives_are_plain_warc(spark):
    _, folder, _ = roundtrip(spark, [(1, "http://a/", "abc", 0, ""), (2, "http://b/", "abc", 0, "")])
    fs, root = common.store(folder)
    from pyarrow.fs import FileSelector

    data = b"".join(gzip.decompress(fs.open_input_file(f.path).read()) for f in fs.get_file_info(FileSelector(root)) if f.path.endswith(".warc.gz"))
    kinds = [x.split(b": ")[1] for x in data.split(b"\r\n") if x.startswith(b"WARC-Type")]
    assert sorted(kinds)[:2] == [b"response", b"revisit"] and data.count(b"WARC-Refers-To: <urn:uuid:") == 1
