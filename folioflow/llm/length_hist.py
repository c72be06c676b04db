"""Exact token counts: a histogram of encoded lengths whose suffix sums answer for every context limit.

Documents are counted by the number of ids that the tokenizer gives for the whole text. From the histogram alone come,
for a limit c: the documents longer than c (suffix sum of counts), the total of min(length, c) (tokens of shorter
documents, plus c for each of the others) and any quantile of the lengths.

Defined cases: a null text is empty and has length 0; repeated rows count as often as they occur; no rows give an
empty histogram; other columns are ignored; ids play no part.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe_text, common

#: Lengths of one block of the two-level sums; only one row a block meets in a single task.
BLOCK = 256


def token_counts(docs: DataFrame, tokenizer: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and n_tokens for every row."""
    common.ship_code(docs.sparkSession)
    path = tokenizer or bpe_text.default_path()
    chosen = docs.select(*keep, common.text_of().alias("_text"))
    schema = chosen.drop("_text").withColumn("n_tokens", F.lit(0).cast("bigint")).schema

    def run(batches):
        for batch in batches:
            n = list(bpe_text.count_all(batch.column(batch.num_columns - 1).to_pylist(), path))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*batch.schema.names[:-1], "n_tokens"])

    return chosen.mapInArrow(common.lean(run), schema)


def histogram(lengths: DataFrame) -> DataFrame:
    """The counts are written once, so texts are encoded once. One row a distinct length: documents and tokens at it, and the suffix sums from it on.

    n_docs, n_tokens: at this length. docs_from, tokens_from: at this length or more. docs_total, tokens_total: of all.
    truncated_total: tokens that stay when every document is cut to this length. share_below: share of documents that
    are shorter, so the q-quantile is the largest length whose share_below is at most q."""
    counted, _ = common.written(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-counts")
    h = counted.select(F.col("n_tokens").alias("length"), "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("n_tokens") / BLOCK).alias("_b"))
    blocks = h.groupBy("_b").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    later = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = blocks.select("_b", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}later") for c in ("_d", "_t")), *(F.sum(c).over(whole).alias(f"{c}all") for c in ("_d", "_t")))
    inside = Window.partitionBy("_b").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        h.withColumns({"_di": F.sum("n_docs").over(inside), "_ti": F.sum("n_tokens").over(inside)})
        .join(blocks, "_b")
        .select("length", "n_docs", "n_tokens", (F.col("_di") + F.col("_dlater")).alias("docs_from"), (F.col("_ti") + F.col("_tlater")).alias("tokens_from"), F.col("_dall").alias("docs_total"), F.col("_tall").alias("tokens_total"))
        .withColumn("truncated_total", F.col("tokens_total") - F.col("tokens_from") + F.col("length") * F.col("docs_from"))
        .withColumn("share_below", (F.col("docs_total") - F.col("docs_from")) / F.col("docs_total"))
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For each limit: documents over it, tokens kept and tokens cut. Answers for any limit, also one that is no length."""
    spark = hist.sparkSession
    asked = spark.createDataFrame([(int(c),) for c in limits], "context_limit bigint")
    per = hist.withColumn("context_limit", F.explode(F.array(*(F.lit(int(c)).cast("bigint") for c in limits))))
    c = F.col("context_limit")
    got = per.groupBy("context_limit").agg(
        F.sum(F.when(F.col("length") > c, F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "context_limit") * F.col("n_docs")).alias("tokens_kept"),
        F.sum("n_tokens").alias("tokens_total"),
    )
    return asked.join(got, "context_limit", "left")


def quantiles(hist: DataFrame, qs: list[float]) -> DataFrame:
    """The q-quantile (the lower one at ties) of the lengths for each q."""
    per = hist.withColumn("q", F.explode(F.array(*(F.lit(float(q)) for q in qs))))
    return per.filter(F.col("share_below") <= F.col("q")).groupBy("q").agg(F.max("length").alias("length"))
