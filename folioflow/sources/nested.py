"""Nested JSON bodies as relations: listings, submissions, registries, facts, and replies of a model.

Each takes rows with one column body (read with spark.read.text(wholetext=True), gzip included); a body that is no JSON
gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_day, padded_id, safe_decimal

#: The fields that are scored, file names that are exhibits.
FIELDS = ("total_revenue", "net_income", "total_assets", "operating_cash_flow")
EXHIBIT = r"(?i)exhibit|(^|[^a-z0-9])ex-?\d"
_FACT = "struct<val:decimal(38,4),start:string,end:string,form:string,filed:string,accn:string>"


def _parsed(rows: DataFrame, schema: str) -> DataFrame:
    return rows.select(F.from_json("body", schema).alias("j"))


def listing(rows: DataFrame) -> DataFrame:
    """(name, size) of a directory; a size that cannot be read is 0."""
    return _parsed(rows, "directory struct<item:array<struct<name:string,size:string>>>").select(F.inline("j.directory.item")).select("name", F.coalesce(F.col("size").try_cast("bigint"), F.lit(0)).cast("bigint").alias("size"))


def primary_document(files: DataFrame) -> DataFrame:
    """The largest HTML file that is neither an index nor an exhibit; of equal sizes the last by name."""
    fit = F.col("name").rlike(r"(?i)\.html?$") & ~F.lower("name").contains("index") & ~F.col("name").rlike(EXHIBIT)
    return files.filter(fit).agg(F.max_by("name", F.struct("size", "name")).alias("name")).filter("name is not null")


def submissions(rows: DataFrame) -> DataFrame:
    """Parallel arrays side by side: (accession, form, filed, document)."""
    cols = ["accessionNumber", "form", "filingDate", "primaryDocument"]
    return _parsed(rows, ", ".join(f"{c} array<string>" for c in cols)).select(F.inline(F.arrays_zip(*(F.col(f"j.{c}") for c in cols)))).toDF("accession", "form", "filed", "document")


def tickers(rows: DataFrame) -> DataFrame:
    """(ticker, cik, title) of a registry keyed by row number."""
    got = rows.select(F.explode(F.map_values(F.from_json("body", "map<string,struct<cik_str:bigint,ticker:string,title:string>>"))).alias("c"))
    return got.select("c.ticker", padded_id(F.col("c.cik_str").cast("string")).alias("cik"), "c.title")


def companies(rows: DataFrame) -> DataFrame:
    return _parsed(rows, "companies array<struct<ticker:string,cik:string,sector:string>>").select(F.inline("j.companies"))


def labelled_queries(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, query, ticker, form, items, cik) of a set of queries with the items where their answers are; cik is that of
    the registry (ticker, cik), empty for a ticker that it lacks."""
    own = _parsed(rows, "queries array<struct<id:string,query:string,ticker:string,form:string,items:array<string>>>").select(F.inline("j.queries"))
    known = registry.groupBy("ticker").agg(F.min("cik").alias("cik"))
    return own.join(known, "ticker", "left").select("id", "query", "ticker", "form", "items", F.coalesce("cik", F.lit("")).alias("cik"))


def observations(rows: DataFrame) -> DataFrame:
    """(taxonomy, tag, unit, val, start_d, end_d, form, filed, accn): facts by taxonomy, tag and unit laid flat; a date
    that cannot be read is null."""
    tags = rows.select(F.explode(F.from_json("body", f"map<string,map<string,struct<units:map<string,array<{_FACT}>>>>>")).alias("taxonomy", "tags"))
    units = tags.select("taxonomy", F.explode("tags").alias("tag", "t")).select("taxonomy", "tag", F.explode("t.units").alias("unit", "facts"))
    return units.select("taxonomy", "tag", "unit", F.inline("facts")).select("taxonomy", "tag", "unit", "val", iso_day("start").alias("start_d"), iso_day("end").alias("end_d"), "form", iso_day("filed").alias("filed"), "accn")


def completions(rows: DataFrame, key: str, reply: str, fiscal_year: int) -> DataFrame:
    """The JSON of a model's reply, a code fence around it taken off, with defaults: no confidence is 0, no currency
    USD, no year the given one. Figures that are no numbers are null; unknown names of abstained fields go. ok is false
    for a reply that is no JSON object, and such a row abstains from all fields."""
    bare = F.regexp_replace(F.trim(reply), r"^```[a-zA-Z]*\s*|\s*```$", "")
    schema = ", ".join(f"{f} string" for f in FIELDS) + ", fiscal_year int, reported_currency string, confidence double, abstained_fields array<string>, _bad string"
    j = F.from_json(bare, schema, {"columnNameOfCorruptRecord": "_bad"})
    got = rows.select(key, j.alias("j")).withColumn("ok", F.col("j").isNotNull() & F.col("j._bad").isNull())
    known = F.filter(F.coalesce("j.abstained_fields", F.array().cast("array<string>")), lambda f: f.isin(*FIELDS))
    return got.select(
        key, "ok", *(safe_decimal(F.col(f"j.{f}")).alias(f) for f in FIELDS[:2]),
        F.coalesce("j.fiscal_year", F.lit(fiscal_year)).alias("fiscal_year"),
        F.coalesce("j.reported_currency", F.lit("USD")).alias("currency"),
        F.coalesce("j.confidence", F.lit(0.0)).alias("confidence"),
        F.array_join(F.when(F.col("ok"), known).otherwise(F.array(*(F.lit(f) for f in FIELDS))), ",").alias("abstained"),
    )
