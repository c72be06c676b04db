"""Landing files once by content, and reading what was landed: objects, manifests, listings, daily indexes.

An archive is a folder with the table objects (prefix, filename, sha256, size, content), a Parquet partition a prefix;
its columns without content are the manifest, which Parquet reads without the bytes."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import padded_id
from ..operators import tables
from .tables import scratch

_OBJECTS = "filename string, sha256 string, size bigint, content binary, prefix string"


def _read(spark: SparkSession, path: str, schema: str, **how) -> DataFrame:
    """The table at a path; without rows if nothing is there."""
    try:
        return spark.read.options(**how).schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def objects(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/objects", _OBJECTS)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return objects(spark, root).drop("content")


def land(root: str, incoming: DataFrame, overwrite: bool = False) -> DataFrame:
    """Lands file sets (prefix, filename, content) and gives (prefix, status): landed and overwritten ones are written as
    whole partitions, unchanged ones and conflicts are not. The decision is written down before the files are, so that
    reading the result does not decide again."""
    spark = incoming.sparkSession
    new = incoming.select("filename", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("size"), "content", F.col("prefix").cast("string").alias("prefix"))
    decided = scratch(spark, "landing")
    tables.landing_status(manifest(spark, root), new.select("prefix", "filename", "sha256"), overwrite).write.parquet(decided)
    status = spark.read.schema("prefix string, status string").parquet(decided)
    go = status.filter(F.col("status").isin("landed", "overwritten")).select("prefix")
    if not go.isEmpty():
        new.join(go, "prefix", "left_semi").select(new.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prefix").parquet(f"{root}/objects")
    return status


def prefixes(spark: SparkSession, root: str, without: str = "companyfacts-") -> DataFrame:
    """The prefixes of an archive, each once, in order, but for those that begin with `without`. They are partitions, so
    no column of any file is read."""
    return objects(spark, root).select("prefix").filter(~F.col("prefix").startswith(without)).distinct().orderBy("prefix")


def raw_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, name, content) of files as they are, undecoded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def index_path(base: str, day: datetime.date) -> str:
    """Where the index of a day lies: year, quarter, day."""
    return f"{base}/{day.year}/QTR{(day.month + 2) // 3}/master.{day:%Y%m%d}.idx"


def daily_index(spark: SparkSession, path: str, forms: list[str] | None = None) -> DataFrame:
    """(cik, company, form, filed, path, accession) of the lines of an index that have five fields, digits for a number
    and a date of the calendar; any case of the forms asked for. A day without an index has no rows."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    p = lines.select(F.split("value", r"\|").alias("p")).filter(F.size("p") == 5).select(*(F.trim(F.col("p")[i]).alias(c) for i, c in enumerate(("cik", "company", "form", "day", "path"))))
    good = p.filter(F.col("cik").rlike("^[0-9]+$") & F.col("day").rlike("^[0-9]{8}$")).withColumn("filed", F.try_to_date("day", "yyyyMMdd")).filter("filed is not null")
    if forms:
        good = good.filter(F.lower("form").isin([f.lower() for f in forms]))
    return good.select(padded_id(F.col("cik")).alias("cik"), "company", "form", "filed", "path", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.txt$", "").alias("accession"))
