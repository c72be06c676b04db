from folioflow.llm import decontam

ITEMS = [
    (1, "one two three"),
    (2, "What is the capital of France?"),
    (3, "世界で一番高い山は何ですか"),
    (4, "42"),
    (5, "Alice Smith has seven cats at home"),
    (6, "Who wrote Faust"),
]


def judge(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontam.judged(docs, spark.createDataFrame(items, "item_id long, text string"), inside=True).collect()
    return {r["doc_id"]: r["item_ids"] for r in got}


def test_short_items_and_heads_inside_longer_texts(spark):
    got = judge(
        spark,
        [
            "zero one two three four five six", "one two four three and so on again",
            "he asked, What is the capital of France? and left", "What is the capital of France?", "1: What is the capital of France? 2",
            "次の質問です世界で一番高い山は何ですか答えは富士山です",
            "there are 42 of them in all of it", "there are 43 of them in all of it", "43",
            "we know that Alice Smith has seven cats at home now", "Alice Smith has seven cats at home",
            "the question was: Who wrote Faust and why", "The question. Who wrote Faust and why", "one two three",
        ],
        ITEMS,
    )
    assert got == {0: [1], 1: [], 2: [2], 3: [2], 4: [2], 5: [3], 6: [4], 7: [], 8: [4], 9: [5], 10: [5], 11: [6], 12: [6], 13: [1]}
