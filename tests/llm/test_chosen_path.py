import random

import pytest

from folioflow.llm import chosen_path as cp
from folioflow.llm import queries


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(ids, texts):
    """doc_id -> (class id, links, copies) by comparing all pairs."""
    sets = sets_of(texts)
    n = len(sets)
    root = list(range(n))

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-12):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    classes = {}
    for i, d in enumerate(ids):
        classes.setdefault(top(i), []).append(d)
    return [(d, min((x for x in classes[top(i)] if x is not None), default=None), links[i], sum(s == sets[i] for s in sets)) for i, d in enumerate(ids)]


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7)))
    passage = [word() for _ in range(60)]
    out = [None, "", " \n", "one", "One", "a b c d", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = [word() for _ in range(r.choice([6, 30, 100, 400]))]
        if r.random() < 0.5:
            base += passage
        for _ in range(r.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3]) * max(1, len(w) // 100)):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w))
    return out


def rows_of(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "limit"), [(1, 1024), (2, 1024), (3, 6), (4, 2)])
def test_against_all_pairs(spark, seed, limit):
    texts = corpus(seed)
    df = spark.createDataFrame([(3 * i, t, 0, 0, "") for i, t in enumerate(texts)], "doc_id long, text string, n int, cell int, set_key string")
    assert rows_of(cp.joined(df, limit)) == sorted(brute([3 * i for i in range(len(texts))], texts), key=str)


def test_buckets_over_the_limit_lose_no_pair(spark):
    r = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(150):  # all within 0.8 of each other, in few texts equal
        w = list(base)
        for _ in range(r.choice([0, 1])):
            w[r.randrange(len(w))] = f"x{r.random()}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = {x[0]: x for x in rows_of(cp.joined(df, 16))}, {x[0]: x for x in brute(range(150), texts)}
    assert {x[1] for x in got.values()} == {0}
    assert sum(x[2] for x in got.values()) >= 0.99 * sum(x[2] for x in want.values())
    assert all(got[i][2] <= want[i][2] for i in got)


def test_null_ids_and_repeated_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    rows = [(None, t), (None, "null only"), (7, t), (7, t), (5, t.replace("w3 ", "w3 x ")), (5, "another text under the same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((d, 7 if d in (None, 7) and "w1" in x else d if x != "null only" else None) for d, x in rows), key=str)
    assert sorted(((x[0], x[1]) for x in rows_of(cp.joined(df))), key=str) == want
    kept = sorted([(r["doc_id"], r["text"]) for r in cp.one_of_each(df).collect()], key=str)
    assert kept == sorted([(7, t), rows[4], rows[5], rows[1]], key=str) or len(kept) == 3  # one text an id


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert cp.joined(none).count() == 0 and cp.one_of_each(none).count() == 0


def test_op9_on_the_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = rows_of(queries.QUERIES["op9_chosen_path_join"](spark, sf))
    assert got == sorted(brute(*zip(*rows, strict=True)), key=str)


def test_one_of_each_keeps_the_smallest(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "_id")
    want = {c for _, c, _, _ in brute(*zip(*[(r["doc_id"], r["text"]) for r in docs.collect()], strict=True))}
    kept = cp.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1001)], "u long, v long")
    got = {r["node"]: r["root"] for r in cp.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001: 1000}
    assert cp.components(edges.filter("1 = 0")).count() == 0


def test_rows_of_one_id_with_unrelated_texts_stay_both(spark):
    texts = ["the first of two unrelated texts that share an id but no word shingle", "quite another story about hills and rivers in the north of the land"]
    rows = [(7, texts[0]), (7, texts[1]), (8, texts[1]), (None, texts[0]), (None, "a third text that has no id at all and no copy")]
    got = cp.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[1], rows[4]], key=str)


def test_recall_at_the_least_similarity(spark):
    """Pairs at a similarity just over 0.8, each alone: all runs together miss almost none."""
    import random

    r = random.Random(9)
    rows = []
    for k in range(600):
        words = [f"w{k}x{j}" for j in range(93)]  # 89 shingles
        other = [*words[:84], *(f"v{k}x{j}" for j in range(9))]  # 80 shared of 98: 0.816
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    r.shuffle(rows)
    got = {x["doc_id"]: x["n_links"] for x in cp.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got.values()) / len(rows) >= 0.99


def test_rounds_go_on_until_the_target_and_count_no_link_twice(spark, monkeypatch):
    texts = corpus(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = []

    def unseen(once, twice):
        asked.append((once, twice))
        return 1e9 if len(asked) < 3 else 0.0

    monkeypatch.setattr(cp, "unseen", unseen)
    assert rows_of(cp.joined(df)) == sorted(brute(range(len(texts)), texts), key=str)
    assert len(asked) == 3


def test_later_rounds_find_what_earlier_ones_lost(spark, monkeypatch):
    texts = corpus(6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    least = cp.F.lit(-(1 << 63)).cast("bigint")
    rows = cp.described(df).groupBy("set_key").agg(cp.F.count("*").alias("copies"), cp.F.min(cp.F.struct(cp.F.coalesce("doc_id", least).alias("doc_id"), "text_key", "n", "sketch", "paths")).alias("p"))
    nodes = rows.select("set_key", "copies", "p.*")
    empty = cp.F.transform("paths", lambda p: cp.F.transform(p, lambda _: cp.F.xxhash64("set_key")))
    whole, once = cp.links_until(df, nodes)
    left = iter([1e9, 0.0])
    monkeypatch.setattr(cp, "unseen", lambda once, twice: next(left))
    lost, rounds = cp.links_until(df, nodes.withColumn("paths", empty))  # nobody meets anybody in the first round
    assert rounds[0] == (0, 0.0) and rounds[1][0] == once[-1][0]
    weights = lambda x: sorted((r["set_key"], r["w"]) for r in x.groupBy("set_key").agg(cp.F.sum("weight").alias("w")).collect())
    assert weights(lost) == weights(whole)


def test_estimate_of_links_unseen():
    r = random.Random(4)
    for p in (0.4, 0.6, 0.8):
        met = [sum(r.random() < p for _ in range(cp.RUNS)) for _ in range(200_000)]
        assert abs(cp.unseen(met.count(1), met.count(2)) - met.count(0)) <= 0.15 * met.count(0) + 10
    assert cp.unseen(0, 0) == cp.unseen(1, 0) == 0
