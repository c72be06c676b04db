import random

import numpy as np
import pytest

from folioflow.llm import linear, ordinal, queries, toxicity


def toxic_corpus(n=400, seed=0):
    r = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        s = [" ".join(r.choice(words) for _ in range(8)) + "." for _ in range(r.randrange(1, 20))]
        bad = i % 5 == 0
        if bad:
            s[r.randrange(len(s))] = f"You {r.choice(['idiot', 'scum', 'Idiots', 'scummy'])}, {r.choice(words)}!"
        rows.append((" ".join(s), int(bad), 1.0))
    return rows


def test_noisy_or_finds_documents_and_sentences():
    model = toxicity.fit(toxic_corpus())
    tokens = toxicity.Tokens(model)
    for text, y, _ in toxic_corpus(100, 1):
        assert (tokens.score(text) >= 0.5) == bool(y)
        found = tokens.located(text) if tokens.score(text) >= 0.5 else []
        assert bool(found) == bool(y)
        for s in found:
            assert text[s["start"] : s["end"]] == s["text"] and s["text"].startswith("You ")
        p = [-np.expm1(-x) for x in tokens.sentences(text)]
        assert abs(tokens.score(text) - (1 - np.prod([1 - x for x in p]))) < 1e-9


def test_without_two_labels_nothing_is_toxic():
    assert toxicity.Tokens(toxicity.fit([])).score("you idiot") < 1e-9
    assert toxicity.Tokens(toxicity.fit([("a b.", 0, 1.0)])).score("you idiot") < 1e-9


def test_odd_rows(spark):
    model = toxicity.fit(toxic_corpus())
    df = spark.createDataFrame([(1, None, 5, "a"), (2, "", 5, "b"), (2, "", 5, "b"), (None, "...\n\n!!! ? .", 5, ""), (4, "ok " * 50000 + ". You idiot.", None, None)], "doc_id long, text string, score int, _text string")
    got = toxicity.scored(df, model).collect()
    assert sorted((str(r["doc_id"]), r["predicted"]) for r in got) == [("1", 0), ("2", 0), ("2", 0), ("4", 1), ("None", 0)]
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == 4
    assert toxicity.scored(df.filter("1 = 0"), model).count() == 0
    graded = ordinal.scored(df, ordinal.fit([("a b", 0, 1.0), ("c d", 1, 1.0)])).collect()
    assert len(graded) == 5 and all(0 <= r["score"] <= 1 for r in graded)


def test_the_sample_leaves_out_the_held_out_fifth(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    sample, counts = linear.labelled_sample(docs, labels, "toxic", 40)
    from zlib import crc32

    known = [(r["doc_id"], r["toxic"]) for r in labels.collect() if crc32(str(r["doc_id"]).encode()) % 5]
    assert counts == {y: sum(b == y for _, b in known) for y in {b for _, b in known}}
    assert len(sample) <= 40 and {t for t, _, _ in sample} <= {r["text"] for r in docs.collect() if any(r["doc_id"] == k for k, _ in known)}
    odd = spark.createDataFrame([(None, 1), (1, None), (3, 1), (3, 0)], "doc_id long, toxic int")
    assert linear.labelled_sample(docs, odd, "toxic", 10)[1] == ({1: 1} if crc32(b"3") % 5 else {})


def test_grades_are_ordered():
    r = random.Random(2)
    rows = []
    for _ in range(600):
        g = r.randrange(4)
        rows.append((" ".join(r.choice(["good"] * g + ["bad"] * (3 - g) + ["the", "of", "and"]) for _ in range(60)), g * 10, 1.0))
    model = ordinal.fit(rows)
    assert model.grades == (0, 10, 20, 30) and (np.diff(model.thresholds) > 0).all()
    tokens = ordinal.Tokens(model)
    s = np.array([tokens.linear(t) for t, _, _ in rows])
    expected = ordinal.tails(model, s) @ np.full(3, 10.0)
    assert np.corrcoef(expected, [g for _, g, _ in rows])[0, 1] > 0.9
    p = ordinal.tails(model, s)
    assert (np.diff(p, axis=1) <= 1e-12).all()
    assert ordinal.fit([]).grades == (0,) and ordinal.fit([("a", 3, 1.0)]).grades == (3,)


@pytest.mark.parametrize(("name", "label"), [("op1_noisy_or_toxicity", "toxic"), ("op4_ordinal_quality", "quality")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, sf).select("doc_id", "held_out", "score", "predicted").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 300
    assert (got["predicted"] == got[label]).mean() > 0.95
    for y in (0, 1):
        assert (got[got[label] == y]["predicted"] == y).mean() > 0.85


def plain_score(model, text):
    """Noisy-or in plain Python over all instances: sets of features a sentence, equal ones once."""
    w = dict(zip(model.names.tolist(), model.weights.tolist(), strict=True))
    bag, now = set(), set()
    for token in [*text.replace("\n", " . ").split(), "."]:
        now |= {f for f in toxicity.features(token) if f in w}
        if token[-1] in ".!?":
            bag |= {frozenset(now)} if now else set()
            now = set()
    return 1 - np.prod([1 - 1 / (1 + np.exp(-(model.bias + sum(w[f] for f in s)))) for s in bag])


def test_every_instance_counts():
    z = np.full(200, np.log(0.045 / 0.955))
    assert toxicity.noisy_or(z, np.zeros(200, np.int64), 1)[0] == pytest.approx(1 - 0.955**200)


def test_many_different_clean_sentences_stay_clean(spark):
    """Of the documents outside training that are clean, all different sentences as one text of the length of the longest."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    tokens = toxicity.Tokens(toxicity.train(docs, labels))
    clean = [r["text"] for r in docs.join(labels.filter("toxic = 0"), "doc_id").filter("crc32(cast(doc_id as string)) % 5 = 0").orderBy("doc_id").select("text").collect()]
    own = [t for t in clean if t and tokens.score(t) < 0.5]
    assert len(own) > 0.98 * len(clean)
    n = np.array([tokens.scores([t])[1][0] for t in own])
    half = int(np.searchsorted(np.cumsum(n), 1500))
    assert tokens.score("\n".join(own[:half])) < 0.5


def test_every_score_is_the_fitted_formula(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    assert len(model.names) and (np.diff(model.names.astype(object)) > 0).all()
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model, locate=False).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        assert got[d] == pytest.approx(plain_score(model, t), abs=1e-9)
    again = toxicity.train(docs, labels)
    assert again.bias == model.bias and (again.weights == model.weights).all()


def test_length_and_repetition_do_not_make_a_text_toxic(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    tokens = toxicity.Tokens(toxicity.train(docs, labels))
    clean = docs.join(labels.filter("toxic = 0"), "doc_id").select("text").collect()
    words = [w for r in clean for w in r["text"].split()]
    r = random.Random(3)
    sentences = [s for t in clean for s in t["text"].replace("\n", ". ").split(". ") if tokens.score(s) < 0.05]
    assert len(sentences) > 300 and len(words) > 1000
    long = ". ".join(r.choice(sentences) for _ in range(100_000)) + "."
    assert tokens.score(long) < 0.5
    assert tokens.score("\n" * 50_000) == 0 and tokens.score("hello there. " * 20_000) < 0.5
    assert tokens.score((sentences[0] + ". ") * 5000) == pytest.approx(tokens.score(sentences[0] + ". "))


def test_ordinal_scores_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal.train(docs, labels)
    got = {r["doc_id"]: r for r in ordinal.scored(docs, model).collect()}
    for d, t in ((r["doc_id"], r["text"] or "") for r in docs.collect()):
        tokens = t.split()
        s = sum(model.weights[i] for i in ordinal.document_features(tokens))
        s += sum(model.weights[i] for x in tokens for i in ordinal.token_features(x)) / max(1, len(tokens))
        tails = [1 / (1 + np.exp(-(s - k))) for k in model.thresholds]
        assert got[d]["tails"] == pytest.approx(tails, abs=1e-9) and got[d]["score"] == pytest.approx(tails[-1], abs=1e-9)
        assert got[d]["expected_grade"] == pytest.approx(model.grades[0] + sum(np.diff(model.grades) * tails), abs=1e-9)
    assert ordinal.scored(docs.filter("1 = 0"), model).count() == 0
