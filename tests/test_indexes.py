"""The postings and vector indexes against scans of the same rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from folioflow import api
from folioflow.operators import postings, retrieval, vector_index

LINES = ["the license", '"of the" -license', "license OR und der", "-the", '"licensed under"', "licensing terms", "", "-the OR und", '"the license of"', "foo-bar OR the", "the -of -und", '-"of the" license']


@pytest.fixture(scope="module")
def docs(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(100_001, None, "en"), (100_002, "", "en"), (100_003, "License " * 3000 + "the end of the license", "en"), (100_004, "!!! ---", "en"), (-5, "the license", "de"), (100_005, "the license", "de")]
    return rows.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string")).persist()


@pytest.mark.parametrize("stemmed", [False, True])
def test_search_gives_the_rows_of_a_scan(spark, docs, stemmed):
    index = postings.build(docs, "doc_id", stemmed=stemmed)
    got = postings.search(index, postings.search_lines(spark, dict(enumerate(LINES)), stemmed), 40).collect()
    chunks = docs.withColumnRenamed("doc_id", "chunk_id").withColumn("text", F.coalesce("text", F.lit("")))
    for i, line in enumerate(LINES):
        want = [(r.chunk_id, r.score) for r in api.lexical(chunks, line, 40, stemmed=stemmed).collect()]
        assert [(r.key, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == i] == want, line


def test_bm25_gives_the_rows_of_a_scan(spark, docs):
    index = postings.build(docs, "doc_id")
    asked = {1: ["the", "license", "licensed"], 2: ["of"], 3: ["und", "nosuchword", "und"], 4: ["nosuchword"], 5: []}
    got = postings.bm25(index, spark.createDataFrame(list(asked.items()), "query_id long, words array<string>"), 15).collect()
    plain = docs.withColumn("text", F.coalesce("text", F.lit("")))
    for i, words in asked.items():
        want = [(r.doc_id, round(r.score, 6)) for r in retrieval.bm25(plain, "doc_id", words, 15).collect()] if words else []
        assert [(r.key, round(r.score, 6)) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == i] == want


def test_tiles_that_cannot_win_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(postings, "TILE", 8)
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["aa", "bb", "cc", "dd"]) for _ in range(30)) + (" rare rare rare" if i in (7, 300, 512) else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = postings.build(docs, "doc_id")
    query = spark.createDataFrame([(1, ["rare", "aa"])], "query_id long, words array<string>")
    tiles, _ = postings.bm25_blocks(index, query, 3)
    kept = {r.keep: r["count"] for r in tiles.groupBy("keep").count().collect()}
    assert kept[False] > 10 * kept[True] > 0
    want = [(r.doc_id, round(r.score, 6)) for r in retrieval.bm25(docs, "doc_id", ["rare", "aa"], 3).collect()]
    assert [(r.key, round(r.score, 6)) for r in postings.bm25(index, query, 3).orderBy("rank").collect()] == want


def test_only_the_bins_of_the_words_are_read(spark, docs):
    index = postings.build(docs, "doc_id")
    query = spark.createDataFrame([(1, ["license"])], "query_id long, words array<string>")
    plan = postings.bm25(index, query, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bin" in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    index = postings.build(none, "doc_id")
    assert postings.search(index, postings.search_lines(spark, {1: "a", 2: "-a"}, False), 5).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    built = vector_index.build(vectors)
    query = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, query array<float>")
    assert built.rows == 0 and vector_index.search(built, query.limit(0), 3, 1).collect() == []


def clustered(spark, n=3000, dims=16):
    rnd = random.Random(4)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(30)]
    rows = [(i, [x + rnd.gauss(0, 0.25) for x in centres[0 if rnd.random() < 0.33 else rnd.randrange(30)]]) for i in range(n)]
    odd = [(n, None), (n + 1, [0.0] * dims), (n + 2, [math.nan] * dims), (n + 3, rows[0][1])]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")


def test_every_vector_is_in_one_list_and_all_lists_are_exact(spark):
    rows = clustered(spark)
    index = vector_index.build(rows)
    lists = index.lists(spark)
    assert lists.count() == rows.count() == lists.select("vec_id").distinct().count()
    assert sorted(r.vec_id for r in lists.filter("cell = -1").collect()) == [3000, 3001, 3002]
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    got = vector_index.search(index, asked, 10, len(index.centres))
    exact = retrieval.dense_topk(asked, rows.filter("vec_id <> 3002"), 10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.collect()))


def test_few_lists_hold_most_neighbours(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "ROW_BLOCK", 700)  # the list with a third of the rows is several blocks
    rows = clustered(spark)
    index = vector_index.build(rows)
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    n = vector_index.probes_for(index, asked, 10)
    found = vector_index.search(index, asked, 10, n)
    exact = retrieval.dense_topk(asked, rows.filter("vec_id <> 3002"), 10)
    assert n <= len(index.centres) // 3
    assert vector_index.recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.9
    one = asked.limit(1)
    plan = vector_index.probed(index, index.probes(one, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    index = vector_index.build(rows)
    n = vector_index.probes_for(index, asked, 10)
    assert vector_index.recall(vector_index.search(index, asked, 10, n), retrieval.dense_topk(asked, rows, 10)).agg(F.avg("recall")).first()[0] >= 0.9


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_words_and_documents_are_not_shuffled_one_by_one(spark, docs):
    texts = docs.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    built = plan_of(postings.tiled(texts, 40, 100.0, True))
    assert built.count("Exchange hashpartitioning") == 1 and "Generate" not in built
    index = postings.build(docs, "doc_id")
    ranked = plan_of(postings.bm25(index, spark.createDataFrame([(1, ["the", "of"])], "query_id long, words array<string>"), 5))
    assert "FlatMapCoGroupsInArrow" in ranked and "explode(arrays_zip(" not in ranked
    lines = postings.search_lines(spark, {1: '"of the"'}, False)
    found = plan_of(postings.search(index, lines, 5)).split("\n")
    laid_out = next(i for i, line in enumerate(found) if "Generate explode(arrays_zip(" in line)
    gathered = next(i for i, line in enumerate(found) if "collect_list(e#" in line)
    assert not [line for line in found[gathered:laid_out] if "Exchange" in line]


def test_a_tile_and_several_blocks_of_queries(spark, docs, monkeypatch):
    monkeypatch.setattr(postings, "TASK_TILES", 1)
    monkeypatch.setattr(postings, "QUERY_BLOCK", 2)
    index = postings.build(docs, "doc_id")
    asked = {i: words for i, words in enumerate([["the"], ["license", "of"], ["und"], ["the", "licensed"], ["nosuchword"]])}
    got = postings.bm25(index, spark.createDataFrame(list(asked.items()), "query_id long, words array<string>"), 3).collect()
    plain = docs.withColumn("text", F.coalesce("text", F.lit("")))
    for i, words in asked.items():
        want = [(r.doc_id, round(r.score, 6)) for r in retrieval.bm25(plain, "doc_id", words, 3).collect()]
        assert [(r.key, round(r.score, 6)) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == i] == want


def test_cells_share_shelves_and_large_cells_have_several(monkeypatch):
    monkeypatch.setattr(vector_index, "ROW_BLOCK", 100)
    assert vector_index.shelved([(-1, 3), (0, 90), (1, 20), (2, 250), (3, 5), (4, 95)]) == {-1: (0, 1), 0: (0, 1), 1: (1, 1), 2: (2, 3), 3: (5, 1), 4: (5, 1)}


def test_a_query_goes_to_a_shelf_once_and_blocks_do_not_change_the_rows(spark, monkeypatch):
    rows = clustered(spark, 600)
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    want = sorted(map(tuple, retrieval.dense_topk(asked, rows, 10).collect()))
    monkeypatch.setattr(vector_index, "ROW_BLOCK", 100)
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 7)
    index = vector_index.build(rows)
    sent = index.asked(asked, len(index.centres)).groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("block").alias("d")).collect()
    assert {r.n for r in sent} == {r.d for r in sent} and max(r.n for r in sent) <= 12 < len(index.centres)
    assert sorted(map(tuple, vector_index.search(index, asked, 10, len(index.centres)).collect())) == want
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 50)
    monkeypatch.setattr(retrieval, "QUERY_ROWS", 7)
    assert sorted(map(tuple, retrieval.dense_topk(asked, rows, 10).collect())) == want
