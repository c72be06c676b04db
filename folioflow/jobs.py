"""Command lines: python -m folioflow.jobs NAME --input FOLDER [--output FOLDER] [--option value ...].

Each job reads tables of a folder, writes its result as Parquet (or, without an output, prints the first rows) and ends
with 0, or with 1 if what it checks does not hold."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import api, settings
from .operators import chunks, documents, resolver, retrieval
from .sources import nested
from .sources.tables import table


def _read(spark: SparkSession, a, name: str) -> DataFrame:
    return table(spark, a.input, name)


def build_universe(spark, a):
    """companies.parquet (body) -> companies a sector."""
    return nested.companies(_read(spark, a, "companies")).groupBy("sector").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("ticker")).alias("tickers")).orderBy("sector")


def probe(spark, a):
    """observations and specs -> share of companies resolved a field and year; fails under --floor."""
    got = resolver.resolved(_read(spark, a, "observations"), _read(spark, a, "specs"))
    all_ = _read(spark, a, "observations").agg(F.countDistinct("cik").alias("companies"))
    rates = got.groupBy("field", "fy").agg(F.countDistinct("cik").alias("resolved"), F.count_if("restated").alias("restated"))
    return rates.join(F.broadcast(all_)).withColumn("ok", F.col("resolved") >= a.floor * F.col("companies"))


def parse_filing(spark, a):
    """filings -> the figures by which chunks are verified."""
    docs = _read(spark, a, "filings")
    return chunks.verified(chunks.assembled(docs, a.window, a.overlap), docs, a.window).withColumn("ok", F.col("bad_offsets") == 0)


def index_corpus(spark, a):
    """pages (page_id, html) or filings -> the chunk table with stemmed tokens."""
    return retrieval.with_tokens(chunks.assembled(_read(spark, a, "filings"), a.window, a.overlap), stemmed=True)


def run_ablation(spark, a):
    """chunks and queries (id, query) -> the ranked chunks of each query of the set."""
    rows, out = _read(spark, a, "chunks"), None
    for q in _read(spark, a, "queries").select("id", "query").orderBy("id").collect():  # a query set of a few dozen lines
        one = api.search(rows, q["query"], a.top).withColumn("id", F.lit(q["id"]))
        out = one if out is None else out.unionByName(one)
    return out


def run_extraction(spark, a):
    """scorecards -> accuracy by field; fails under --floor."""
    return api.accuracy(_read(spark, a, "scorecards"), a.model, a.floor).withColumnRenamed("passed", "ok")


def measure_context_coverage(spark, a):
    """hits -> the contexts that the budget admits."""
    return documents.admitted(_read(spark, a, "hits"), "question", a.top, a.cap)


def sweep_context_budget(spark, a):
    """hits -> how many chunks and tokens contexts have for budgets from 1 to --top."""
    held = documents.admitted_to(_read(spark, a, "hits"), "question", F.sequence(F.lit(1), F.lit(a.top)), a.cap)
    return held.groupBy("budget").agg(F.avg("n").alias("chunks"), F.avg("tokens").alias("tokens")).orderBy("budget")


def diagnose_abstentions(spark, a):
    """abstentions (question, value, context) -> whether the figure stood in the context."""
    from .functions.text import figure_forms

    rows = _read(spark, a, "abstentions")
    return rows.select("question", F.exists(figure_forms(F.col("value")), lambda f: F.contains("context", f)).alias("present"))


def diagnose_wrong_tags(spark, a):
    """observations and answers (cik, fy, val) -> the tags whose annual value is within half a percent of the answer."""
    from .functions.text import fiscal_year

    rows = _read(spark, a, "observations").filter(resolver.is_annual(F.col("start_d"), F.col("end_d"))).withColumn("fy", fiscal_year(F.col("end_d")))
    asked = _read(spark, a, "answers").select("cik", "fy", F.col("val").alias("asked"))
    return rows.join(asked, ["cik", "fy"]).filter(F.abs(F.col("val") - F.col("asked")) <= 0.005 * F.abs(F.col("asked"))).select("cik", "fy", "tag", "val").distinct()


def seed_sample(spark, a):
    """filings -> the --top filings with the smallest hashes, the same in every run."""
    return _read(spark, a, "filings").orderBy(F.xxhash64("accession"), "accession").limit(a.top)


def demo(spark, a):
    """filings -> the passages for --query, cited."""
    return api.ask(chunks.assembled(_read(spark, a, "filings"), a.window, a.overlap), a.query, min(a.top, 20))


JOBS = {f.__name__: f for f in (build_universe, probe, parse_filing, index_corpus, run_ablation, run_extraction, measure_context_coverage, sweep_context_budget, diagnose_abstentions, diagnose_wrong_tags, seed_sample, demo)}


def main(args: list[str], spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="folioflow.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--input", required=True)
    p.add_argument("--output")
    p.add_argument("--query", default="")
    p.add_argument("--model")
    p.add_argument("--floor", type=float, default=0.7)
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--cap", type=int)
    p.add_argument("--window", type=int, default=512)
    p.add_argument("--overlap", type=int, default=64)
    a = p.parse_args(args)
    settings.Settings("jobs@example.org", a.window, a.overlap)
    spark = spark or SparkSession.builder.getOrCreate()
    settings.begin_run(spark, a.job)
    got = JOBS[a.job](spark, a)
    if a.output:
        got.write.mode("overwrite").parquet(a.output)
        got = spark.read.parquet(a.output)
    else:
        got.show(20, False)
    return int("ok" in got.columns and not got.filter(~F.col("ok")).isEmpty())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
