"""Texts that are one run of names or of figures, as long as the longest documents."""

import pytest
from pyspark.sql import functions as F

from folioflow.llm import decontam

ITEM = "The quick brown fox jumps over the lazy dog while seven sleepy cats watch from the old wooden fence"


@pytest.mark.parametrize("run", ["Retionth ", "1.2,"])
def test_a_run_of_twenty_thousand_words_is_read_and_the_item_behind_it_found(spark, run):
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit(run), 20_000), F.when(F.col("id") == 1, F.lit(f"\n{ITEM}")).otherwise("")).alias("text"))
    got = decontam.judged(docs, spark.createDataFrame([(7, ITEM)], "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == {0: [], 1: [7]}


def test_a_run_is_one_name_or_one_figure(spark):
    row = spark.range(1).select(decontam.raw_tokens(F.repeat(F.lit("Ab "), 5000)).alias("names"), decontam.raw_tokens(F.concat(F.repeat(F.lit("1:"), 5000), F.lit("2"))).alias("figures")).first()
    assert [len(x) for x in row["names"]] == [5000 * 3 + 1] and row["names"][0] == "\x01" + " ".join(["ab"] * 5000) + "\x04"
    assert row["figures"] == ["\x02" + "1:" * 5000 + "2\x04"]
