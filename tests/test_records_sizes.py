"""Texts of every length around the least chunk, which the small tables lack."""

import duckdb

from folioflow.plans import queries as plans


def test_stale_chunks_of_texts_around_the_least_size(spark, tmp_path):
    rows = [(i, " ".join(["word"] * (i // 7 + 12))) for i in range(100)] + [(1000, None), (1001, "")]
    folder = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'src1' AS source")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, plans.queries()["chunk_stale"](spark, folder).collect()))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert got == sorted(duck.execute(plans.oracle_sql()["chunk_stale"]).fetchall())


def test_stale_chunks_of_texts_that_repeat_themselves(spark, tmp_path):
    """Every period from two characters on, windows that lie within the repetition among them."""
    said = [("a" * (n - 1) + " ") * (9000 // n) for n in range(2, 40)] + ["Hant " * 400 + "a " * 900, "One two. " * 700, "a b\n" * 900]
    folder = str(tmp_path)
    rows = [(7 * i + k, t) for i, t in enumerate(said) for k in (0, 1, 2, 3)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'src1' AS source").write.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, plans.queries()["chunk_stale"](spark, folder).collect()))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert got == sorted(duck.execute(plans.oracle_sql()["chunk_stale"]).fetchall()) and len(got) == 2 * len(said)


def test_the_chunks_that_are_verified_are_cut_once(spark, sf):
    plan = plans.queries()["chunk_invariants"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
