"""Chunk tables: parsed documents cut at their items and into windows, tables whole, each row fit to be cited."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import estimated_tokens, windows
from .headings import with_regions
from .resolver import filing_year

#: The columns of a chunk table.
COLUMNS = "chunk_id string, accession string, cik string, company string, form string, filed date, fiscal_year int, item_number string, item_title string, section string, chunk_type string, char_start int, char_end int, token_count int, text string"
_TYPES = {"string": pa.string(), "date": pa.date32(), "int": pa.int32()}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in COLUMNS.split(", ")]).remove(6)
#: Documents taken out of an Arrow batch at once, and characters of chunks that are given on at once.
ROWS, CHARS = 32, 1 << 20


def pieces(text: str, blocks: list[dict], regions: list[dict], size: int, overlap: int, least: int) -> list[tuple]:
    """(label, region or None, kind, start, end, tokens) of a document's chunks in order. Prose is cut where items begin
    and windowed inside each; a table is one chunk of the item in which it starts, however long."""
    starts = [r["start"] for r in regions]
    out, numbers = [], {}

    def add(at: int, kind: str, start: int, end: int, tokens: int) -> None:
        k = bisect_right(starts, at) - 1
        region = regions[k] if k >= 0 and at < regions[k]["end"] else None
        name = f"item{region['item']}" if region else "front"
        numbers[name] = numbers.get(name, 0) + 1
        out.append((f"{name}::c{numbers[name]}", region, kind, start, end, tokens))

    for b in blocks:
        if b["kind"] == "table":
            body = text[b["start"] : b["end"]]
            if body.strip():
                first = b["start"] + len(body) - len(body.lstrip())
                add(b["start"], "table", first, first + len(body.strip()), estimated_tokens(body))
            continue
        edges = [b["start"], *(s for s in starts if b["start"] < s < b["end"]), b["end"]]
        for a, z in zip(edges, edges[1:], strict=False):
            for start, end, tokens in windows(text[a:z], size, overlap, least):
                add(a, "prose", a + start, a + end, tokens)
    return out


def assembled(docs: DataFrame, size: int = 512, overlap: int = 64, least: int = 32) -> DataFrame:
    """The chunk table of documents (accession, cik, company, form, filed, text, and blocks array<struct<kind, start,
    end>>, null: one block of prose). Null and blank texts have no chunks; a repeated accession repeats its chunks."""
    rows = with_regions(docs.filter("accession is not null")).select("accession", "cik", "company", "form", "filed", "text", "blocks", "regions")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield from _cut(batch.slice(at, ROWS).to_pylist(), size, overlap, least)

    got = rows.mapInArrow(run, COLUMNS.replace("fiscal_year int, ", "")).withColumn("fiscal_year", filing_year(F.col("form"), F.col("filed")))
    return got.select(*(c.split()[0] for c in COLUMNS.split(", ")))


def _cut(rows: list[dict], size: int, overlap: int, least: int) -> Iterator[pa.RecordBatch]:
    """The chunks of a few documents, in batches that no longer grow once they have CHARS characters."""
    out, held = [], 0
    for r in rows:
        text = r["text"] or ""
        blocks = r["blocks"] if r["blocks"] is not None else [{"kind": "prose", "start": 0, "end": len(text)}]
        for label, region, kind, a, z, tokens in pieces(text, blocks, r["regions"] or [], size, overlap, least):
            of = region or {"item": None, "title": None, "section": "Unknown"}
            out.append((f"{r['accession']}::{label}", r["accession"], r["cik"], r["company"], r["form"], r["filed"], of["item"], of["title"], of["section"], kind, a, z, tokens, text[a:z]))
            held += z - a
            if held >= CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def stale(chunks: DataFrame, docs: DataFrame) -> DataFrame:
    """(accession, chunks, moved): documents that no longer give the text of each of their chunks at its offsets, how many
    chunks they have and how many of these differ. A document that is gone or without a text has lost all its chunks."""
    both = chunks.join(docs.select("accession", F.col("text").alias("_whole")), "accession", "left")
    here = F.substring("_whole", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    per = both.groupBy("accession").agg(F.count("*").alias("chunks"), F.count_if(~here.eqNullSafe(F.col("text"))).alias("moved"))
    return per.filter("moved > 0")


def verified(chunks: DataFrame, docs: DataFrame, size: int = 512, crossed: Column | None = None) -> DataFrame:
    """One row: chunks, those whose offsets do not give their text, whose prose is over 1.1 times the size, and the
    smallest, largest and mean number of tokens; with `crossed`, a place in the column _whole, the chunks that have the
    characters on both sides of the one there."""
    both = chunks.join(docs.select("accession", F.col("text").alias("_whole")), "accession")
    bad = F.substring("_whole", F.col("char_start") + 1, F.col("char_end") - F.col("char_start")) != F.col("text")
    large = (F.col("chunk_type") == "prose") & (F.col("token_count") > 1.1 * size)
    return both.agg(
        F.count("*").alias("n"), F.count_if(bad).alias("bad_offsets"), F.count_if(large).alias("oversized"), F.min("token_count").alias("least"),
        F.max("token_count").alias("most"), F.floor(F.avg("token_count")).alias("mean"),
        *([] if crossed is None else [F.count_if((F.col("char_start") < crossed) & (F.col("char_end") > crossed + 1)).alias("crossing")]),
    )
