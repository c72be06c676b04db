"""Queries whose SQL both engines could run, as library code on this side: what the SQL of plans/queries.py checks is
then the operator and not another engine's reading of one text."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cache, intervals, retrieval, tables
from ..sources.tables import table
from .fixtures import HEADINGS, NEW, OLD, RUN_A, RUN_B, SCORES, values

RIGHT = ("exact", "within_tolerance")


def filter_metadata(spark, folder):
    fit = retrieval.metadata_filter(equal={"source": "src3"}, at_least={"n_chars": 500}) & (F.upper("lang") == "EN")
    return table(spark, folder, "documents").filter(fit).select("doc_id", "source", "lang", "n_chars")


def filter_in_list(spark, folder):
    fit = retrieval.metadata_filter(any_of={"lang": ["de", "fr"], "source": ["src1", "src2"]})
    return table(spark, folder, "documents").filter(fit).select("doc_id", "lang")


def filter_year_range(spark, folder):
    """Years as a range of dates, which the scan takes over; a function of the column would be computed for every row."""
    fit = retrieval.metadata_filter(at_least={"o_orderdate": datetime.date(1995, 1, 1)}) & (F.col("o_orderdate") < datetime.date(1997, 1, 1)) & (F.col("o_totalprice") > 200000)
    return table(spark, folder, "orders").filter(fit).select("o_orderkey", "o_totalprice")


def filter_like_prefix(spark, folder):
    return table(spark, folder, "part").filter(F.upper("p_type").startswith("PROMO")).select("p_partkey", "p_type")


def incremental_pending(spark, folder):
    return tables.pending(values(spark, folder, NEW), values(spark, folder, OLD), "id", "digest").select("id", "digest")


def _verdicts(spark: SparkSession, folder: str) -> DataFrame:
    v = T.verdict(F.col("val"), F.col("truth"), F.col("abstained"))
    return values(spark, folder, SCORES).select("accession", "field", v.alias("verdict"))


def _right():
    return F.col("verdict").isin(*RIGHT).cast("double")


def verdict_rows(spark, folder):
    return _verdicts(spark, folder)


def scorecard_accuracy(spark, folder):
    scored = _verdicts(spark, folder).filter("verdict <> 'unresolvable'")
    return scored.groupBy("accession").agg(F.round(F.avg(_right()), 4).alias("accuracy"))


def failure_taxonomy(spark, folder):
    return _verdicts(spark, folder).filter(~F.col("verdict").isin(*RIGHT)).groupBy("verdict").agg(F.count("*").alias("n"))


def quality_gate(spark, folder):
    one = _verdicts(spark, folder).filter("verdict <> 'unresolvable'").agg(F.avg(_right()).alias("measured"))
    return one.select("measured", F.lit(0.6).alias("floor"), (F.col("measured") >= 0.6).alias("passed"))


def item_monotonic(spark, folder):
    rows = values(spark, folder, HEADINGS).withColumn("place", F.struct("doc", "part"))
    return intervals.running_records(rows, "place", "pos", "num").select("doc", "part", "pos", "num")


def rrf_terms(spark, folder):
    return retrieval.rrf([values(spark, folder, RUN_A), values(spark, folder, RUN_B)], "id").select("id", "score", "n_runs")


def cache_stats(spark, folder):
    held = values(spark, folder, OLD).select("id", "digest", F.lit(True).alias("hit"))
    looked_up = values(spark, folder, NEW).select("id", "digest").join(held, ["id", "digest"], "left")
    return cache.hit_rate(looked_up.withColumn("hit", F.coalesce("hit", F.lit(False))))


def metric_gauge_last(spark, folder):
    newest = tables.latest(table(spark, folder, "events").select("event_type", "ts", "event_id"), ["event_type"], "ts")
    return newest.select("event_type", "event_id")


def store_stats(spark, folder):
    d = table(spark, folder, "documents")
    return d.agg(F.count("*").alias("n"), F.count("text").alias("n_text"), F.countDistinct("source").alias("n_sources"), F.max("n_chars").alias("longest"))


def block_offsets(spark, folder):
    """Where each document of a source begins if they are joined by two signs; a source may hold most of the rows."""
    d = table(spark, folder, "documents").select("doc_id", "source", (F.col("n_chars") + 2).alias("size"))
    got = intervals.running_total(d, "source", "doc_id", "size", 4096, "end_at")
    return got.select("doc_id", "source", (F.col("end_at") - F.col("size")).alias("start_at"))


QUERIES = {
    f.__name__: f
    for f in (
        filter_metadata, filter_in_list, filter_year_range, filter_like_prefix, incremental_pending, verdict_rows, scorecard_accuracy,
        failure_taxonomy, quality_gate, item_monotonic, rrf_terms, cache_stats, metric_gauge_last, store_stats, block_offsets,
    )
}
