"""The one-call surface: search, ask, latest_scorecard, accuracy, health and metrics, each a DataFrame.

Chunks are rows of (chunk_id, text) and whatever the filters name; scorecards are rows of (accession, model,
evaluated_at, scores array<struct<field, verdict>>)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .operators import retrieval

#: The verdicts that count, and those that count as right.
SCOREABLE = ("exact", "within_tolerance", "scale_error", "hallucinated", "abstained", "wrong")
RIGHT = ("exact", "within_tolerance")


def lexical(chunks: DataFrame, query: str, k: int = 50, where: Column | None = None, stemmed: bool = True) -> DataFrame:
    """(chunk_id, score, rank): the k best rows that fit a search line, by cover density of its words, then id; by
    English stems without stop words, or by plain tokens."""
    words = retrieval.plain_words(query, stemmed)
    rows = retrieval.with_tokens(chunks if where is None else chunks.filter(where), stemmed=stemmed)
    fit = rows.filter(retrieval.web_condition(F.col("tokens"), query, stemmed))
    score = F.round(retrieval.cover_density(F.col("tokens"), words), 9) if words else F.lit(0.0)
    best = fit.select("chunk_id", score.alias("score")).orderBy(F.desc("score"), "chunk_id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "chunk_id")))


def search(chunks: DataFrame, query: str, top_k: int = 10, where: Column | None = None, dense: DataFrame | None = None, candidates: int = 50, stemmed: bool = True) -> DataFrame:
    """The top_k chunks (0: all candidates) by rank fusion of the lexical run and, if given, a dense run (chunk_id,
    rank): chunk_id, text, score, n_runs. A blank query is refused."""
    if not query.strip():
        raise ValueError("the query is blank")
    runs = [lexical(chunks, query, candidates, where, stemmed).select("chunk_id", "rank")]
    if dense is not None:
        runs.append(dense.filter(F.col("rank") <= candidates).select("chunk_id", "rank"))
    best = retrieval.rrf(runs, "chunk_id", top=top_k or None)
    return best.join(chunks.select("chunk_id", "text"), "chunk_id").orderBy(F.desc("score"), "chunk_id")


def ask(chunks: DataFrame, query: str, top_k: int = 5, where: Column | None = None, stemmed: bool = True) -> DataFrame:
    """Passages for a question, each with its citation."""
    if not 1 <= top_k <= 20:
        raise ValueError("top_k is from 1 to 20")
    return search(chunks, query, top_k, where, stemmed=stemmed).withColumn("citation", F.struct("chunk_id", F.substring("text", 1, 300).alias("passage")))


def latest_scorecard(cards: DataFrame, accession: str) -> DataFrame:
    """The newest scorecard of a filing; no row if there is none."""
    return cards.filter(F.col("accession") == accession).orderBy(F.desc("evaluated_at"), "model").limit(1)


def accuracy(cards: DataFrame, model: str | None = None, floor: float = 0.9) -> DataFrame:
    """(field, n, accuracy, passed) over scoreable verdicts of one model, or of all."""
    rows = cards if model is None else cards.filter(F.col("model") == model)
    flat = rows.select(F.inline("scores")).filter(F.col("verdict").isin(*SCOREABLE))
    per = flat.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.col("verdict").isin(*RIGHT).cast("double")).alias("accuracy"))
    return per.withColumn("passed", F.col("accuracy") >= floor)


def health(chunks: DataFrame, filed: str, now: Column | None = None, slo_seconds: int = 86_400) -> DataFrame:
    """One row: rows, rows with text, the newest date, the seconds since it, whether that is within the objective."""
    today = F.current_date() if now is None else now
    one = chunks.agg(F.count("*").alias("n"), F.count("text").alias("n_text"), F.max(filed).alias("newest"))
    one = one.withColumn("age_seconds", F.datediff(today, "newest").cast("bigint") * 86_400)
    return one.withColumn("fresh", F.coalesce(F.col("age_seconds") < slo_seconds, F.lit(False)))


def metrics(health_row: DataFrame, accuracy_rows: DataFrame) -> DataFrame:
    """(name, label, value): the gauges that were measured; those that are null are left out."""
    gauges = health_row.select(F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.lit("").alias("label"), F.col(c).cast("double").alias("value")) for n, c in (("index_rows", "n"), ("index_age_seconds", "age_seconds"))))))
    return gauges.unionByName(accuracy_rows.select(F.lit("accuracy").alias("name"), F.col("field").alias("label"), F.col("accuracy").alias("value"))).filter("value is not null")
