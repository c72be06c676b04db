"""WARC archives (a gzip member a record) with an index: writing records, and reading back the selected ones by byte ranges.

Writing: records with equal payloads are found by SHA-1; the one with the smallest page_id carries the payload
(response), the others point to it (revisit). Each task writes one archive and gives an index row a record: offset,
length, URL and digest. Reading needs only the index: its rows are sorted by file and offset, neighbouring ranges are
coalesced into one read, and each record is cut from the bytes read and verified.

Defined cases: a null html is an empty payload; a null URL is written as an empty one; a repeated row (same page_id,
same payload) is written each time, as response if its page_id is the smallest of its payload; a null page_id is
larger than any other, and rows of null ids alone that have one payload are responses all; a payload of any length is
one record; no rows give an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: One read takes at most this many bytes over; gaps up to GAP are read along.
READ = 8 << 20
GAP = 64 << 10
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_INDEX = "page_id bigint, url string, file string, offset bigint, length bigint, payload_digest string, record_type string, refers_to bigint"
_KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
_ROWS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and refers_to: null for a response, else the page_id of the response with the same payload.

    The payload groups are counted before anything is joined; a group that holds a third of all pages is one row there,
    and on the side of the pages the join may split it."""
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), common.text_of("html").alias("payload"))
    own = own.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    first = own.groupBy("sha").agg(F.min("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1").select("sha", "response")
    return own.join(first, "sha", "left").select("page_id", "url", "payload", F.when(F.col("response") != F.coalesce("page_id", F.col("response") + 1), F.col("response")).alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str]:
    """(bytes of the record, payload digest). The HTTP header of a revisit keeps the length of the full payload."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url, safe=_SAFE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


_SAFE = "".join(map(chr, range(33, 127)))


def member(data: bytes) -> bytes:
    """A record as a gzip member of its own, so a reader can start at any record."""
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives and gives the index (lazily: materialise it once; only its files count)."""

    def run(batches):
        out = None
        for batch in batches:
            rows = []
            ids, urls, payloads, refers = (batch.column(i).to_pylist() for i in range(4))
            for page_id, url, payload, ref in zip(ids, urls, payloads, refers, strict=True):
                if out is None:
                    out = common.SharedFile(folder, "pages", ".warc.gz")
                    info = b"software: folioflow\r\nformat: WARC File Format 1.1\r\n"
                    out.write(member(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"))
                data, digest = record(page_id, url, payload.encode(), ref, date)
                data = member(data)
                rows.append((page_id, url, out.name, out.write(data), len(data), digest, "response" if ref is None else "revisit", ref))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], [x.split()[0] for x in _INDEX.split(", ")])
        if out is not None:
            out.close()

    return pages.mapInArrow(common.lean(run), _INDEX)


def coalesced(ranges: list[tuple[int, int]], most: int = READ, gap: int = GAP) -> list[tuple[int, int, int]]:
    """Sorted (offset, length) ranges as reads: (index of the first range, index after the last, end offset)."""
    out: list[tuple[int, int, int]] = []
    for i, (at, n) in enumerate(ranges):
        if out and at - out[-1][2] <= gap and at + n - ranges[out[-1][0]][0] <= most:
            out[-1] = (out[-1][0], i + 1, max(out[-1][2], at + n))
        else:
            out.append((i, i + 1, at + n))
    return out


_FIELD = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


def parse(data: bytes) -> dict:
    """Header fields (lower-case names) of one record, its block, and the payload length that its HTTP header tells."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this offset")
    got = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(head[head.index(b"\r\n") + 2 :] + b"\r\n")}
    n = int(got["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("the record does not end where its index row says")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(http[http.index(b"\r\n") + 2 :] + b"\r\n")}
    return got | {"payload": payload, "payload_bytes": int(fields["content-length"])}


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Reads the records that the index rows name: one row each, response payloads verified against their digest.

    Rows are dealt by file and 32 MB stretch of it, so a long file is read by several tasks."""
    spark = index.sparkSession

    def flush(rows, fs, root, opened):
        out = []
        for i, j, end in coalesced([(r["offset"], r["length"]) for r in rows]):
            first = rows[i]["offset"]
            opened.seek(first)
            data = opened.read(end - first)
            for r in rows[i:j]:
                got = parse(zlib.decompress(data[r["offset"] - first : r["offset"] - first + r["length"]], 31))
                digest, kind = got["warc-payload-digest"].removeprefix("sha1:"), got["warc-type"]
                if digest != r["payload_digest"] or kind == "response" and (base32_sha1(got["payload"]) != digest or len(got["payload"]) != got["payload_bytes"]):
                    raise ValueError(f"damaged record at {r['file']}:{r['offset']}")
                ids = [int(got[k]) if got.get(k) else None for k in ("x-page-id", "x-refers-to-page-id")]
                out.append((ids[0], got["warc-target-uri"], got["payload_bytes"], digest, kind, ids[1]))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()], strict=True)], [x.split()[0] for x in _ROWS.split(", ")])

    def run(batches):
        fs, root = common.store(folder)
        name, opened = None, None
        for batch in batches:
            rows = batch.to_pylist()
            i = 0
            while i < len(rows):
                j = i
                while j < len(rows) and rows[j]["file"] == rows[i]["file"]:
                    j += 1
                if rows[i]["file"] != name:
                    if opened:
                        opened.close()
                    name = rows[i]["file"]
                    opened = fs.open_input_file(f"{root}/{name}")
                yield flush(rows[i:j], fs, root, opened)
                i = j
        if opened:
            opened.close()

    chosen = index.select("file", "offset", "length", "payload_digest")
    return chosen.repartition(common.cores(spark), "file", F.floor(F.col("offset") / (32 << 20))).sortWithinPartitions("file", "offset").mapInArrow(common.lean(run), _ROWS)


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Writes all pages; the index as a table in the shared folder, and the folder of the archives."""
    spark = pages.sparkSession
    common.ship_code(spark)
    folder = common.new_path(spark, "warc")
    index, _ = common.written(write_archives(with_roles(pages), folder), "warc-index")
    return index, folder
