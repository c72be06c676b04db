from folioflow.llm import decontam, queries

ITEMS = [
    (1, "If Alice Smith buys 12 apples for 3 dollars each and sells 12 pears, how much does she spend on the apples in all?"),
    (2, "The quick brown fox jumps over the lazy dog while seven sleepy cats watch from the old wooden fence"),
    (3, "one two three"),
    (4, None),
    (5, ""),
]


def judge(spark, texts, items=ITEMS):
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, contaminated boolean")
    got = decontam.judged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {r["doc_id"]: r["item_ids"] for r in got}


def test_exact_and_reparameterised_items(spark):
    texts = [
        "Before that. " + ITEMS[0][1] + " After that.",
        "word and then If Bob Jones buys 40 apples for 7 euros each and sells 40 pears, how much does she spend on the apples in all? yes",
        "If Bob Jones buys 40 apples for 7 euros each and sells 41 pears, how much does she spend on the apples in all?",  # 12 is 40 and 41
        "If Bob Jones buys 40 oranges, 3 limes and a kiwi each and sells 12 pears, how much does he pay?",
        "so the quick brown fox jumps over the lazy dog while seven sleepy cats watch from the old wooden fence",
        "The quick brown fox jumps over the lazy dog",  # part of it only
        "one two three", "one two three four", None, "", "x " * 30000 + ITEMS[1][1],
    ]
    got = judge(spark, texts)
    assert got[0] == [1] and got[1] == [1] and got[2] == [] and got[3] == []
    assert got[4] == [2] and got[5] == [] and got[6] == [3] and got[10] == [2]
    assert got[7] == got[8] == got[9] == []


def test_equal_items_repeated_rows_and_empty_tables(spark):
    items = [(1, ITEMS[1][1]), (1, ITEMS[1][1]), (9, ITEMS[1][1]), (None, ITEMS[1][1])]
    assert judge(spark, [ITEMS[1][1]] * 3, items) == {i: [None, 1, 9] for i in range(3)}
    assert judge(spark, ["a b c"], []) == {0: []}
    assert judge(spark, []) == {}
    docs = spark.createDataFrame([(1, ITEMS[1][1], 7), (None, "clean text", 8), (None, "clean text", 8)], "doc_id long, text string, _text_key int")
    kept = decontam.without(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(None, "clean text", 8)] * 2


def test_canonical_tokens(spark):
    df = spark.createDataFrame([("We met Dr Who at 3.5 km, then 20% of 1,000 People; it cost 5kg.",)], "text string")
    got = df.select(decontam.raw_tokens(df["text"])).first()[0]
    assert [t.rstrip("\x04") for t in got] == ["we", "met", "\x01dr who", "at", "\x023.5", "\x03km", "then", "\x0220", "\x03%", "of", "\x021,000", "\x01people", "it", "cost", "\x025", "\x03kg"]


def test_op2_finds_every_item_that_a_text_contains(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {r["doc_id"]: r["item_ids"] for r in queries.QUERIES["op2_template_decontamination"](spark, sf).collect()}
    want = {d: sorted(i for i, x in items.items() if x in t) for d, t in texts.items()}
    assert set(got) == set(texts) and sum(map(bool, want.values())) > 5
    for d in texts:
        assert set(want[d]) <= set(got[d])
        for i in set(got[d]) - set(want[d]):  # what is found besides shares most of its words
            w = items[i].split()
            assert sum(" ".join(w[k : k + 4]) in texts[d] for k in range(len(w) - 3)) >= 0.5 * (len(w) - 3)
