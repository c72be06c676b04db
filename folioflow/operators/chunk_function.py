"""chunk_document as a table function of SQL: the chunks of one text, for lateral joins."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import ship_code
from .chunks import pieces
from .headings import with_regions
from .resolver import filing_year

RETURNS = "ordinal int, label string, item_number string, item_title string, section string, chunk_type string, char_start int, char_end int, token_count int, chunk string"


class ChunkDocument:
    """One row a chunk, in order. blocks and regions may be null: then one block of prose, and no items."""

    def eval(self, text: str, blocks: list, regions: list, size: int, overlap: int, least: int) -> Iterator[tuple]:
        text = text or ""
        blocks = [b.asDict() if hasattr(b, "asDict") else b for b in blocks] if blocks is not None else [{"kind": "prose", "start": 0, "end": len(text)}]
        regions = [r.asDict() if hasattr(r, "asDict") else r for r in regions or []]
        for i, (label, region, kind, start, end, tokens) in enumerate(pieces(text, blocks, regions, size, overlap, least)):
            of = region or {"item": None, "title": None, "section": "Unknown"}
            yield i, label, of["item"], of["title"], of["section"], kind, start, end, tokens, text[start:end]


def register(spark: SparkSession) -> None:
    """chunk_document(text, blocks, regions, size, overlap, least) for SQL; rows go to workers in Arrow batches."""
    ship_code(spark)
    spark.udtf.register("chunk_document", F.udtf(ChunkDocument, returnType=RETURNS, useArrow=True))


def assembled(docs: DataFrame, size: int = 512, overlap: int = 64, least: int = 32) -> DataFrame:
    """The rows of chunks.assembled, by a lateral join with the table function."""
    spark = docs.sparkSession
    register(spark)
    rows = with_regions(docs).withColumn("fiscal_year", filing_year(F.col("form"), F.col("filed")))
    return spark.sql(
        f"""SELECT concat(d.accession, '::', c.label) AS chunk_id, d.accession, d.cik, d.company, d.form, d.filed, d.fiscal_year,
        c.item_number, c.item_title, c.section, c.chunk_type, c.char_start, c.char_end, c.token_count, c.chunk AS text
        FROM {{rows}} d, LATERAL chunk_document(d.text, d.blocks, d.regions, {size}, {overlap}, {least}) c""",
        rows=rows,
    )
