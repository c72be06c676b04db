import hashlib

import corpus_pipeline
from folioflow.llm import bpe_text, toxicity

from .test_chosen_path import brute as classes_of
from .test_suffix_dedup import brute as repeats_of


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r["doc_id"]: r for r in docs.collect()})
        if name != "bpe_encoding":
            assert docs.columns == columns
    first = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    model = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    tokens = toxicity.Tokens(model)
    clean = {d: t for d, t in first.items() if tokens.score(t) < 0.5}
    assert set(kept[0]) == set(clean)
    assert set(kept[1]) == {c for _, c, _, _ in classes_of(list(clean), list(clean.values()))}
    left = {d: first[d] for d in kept[1]}
    for d, r in zip(left, repeats_of(list(left.values())), strict=True):
        if r[1] == 0:
            assert kept[2][d]["text"] == left[d]
        elif d in kept[2]:
            assert 0 <= len(kept[2][d]["text"].encode()) - (r[0] - r[1]) <= 8 * r[2]
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(kept[3]) <= set(kept[2])
    assert not any(x in r["text"] for r in kept[3].values() for x in items)
    assert len(kept[3]) > 0.5 * len(kept[2])
    for d, r in kept[4].items():
        ids = bpe_text.library(bpe_text.default_path()).encode(kept[3][d]["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(kept[3][d]["text"].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns[:2] == ["doc_id", "n_tokens"] and got.count() > 50


def test_odd_tables_go_through_every_stage(spark, sf, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _text string, text_key long, size int, key string, root long, c0 string"
    long = " ".join(f"word{i}" for i in range(150_000))
    copied = " ".join(f"w{i}" for i in range(80))
    texts = [(1, None), (2, ""), (3, long), (4, copied), (4, copied), (None, "no id here but a few words"), (None, None), (5, copied + " and more words that only this one has at its end " + "x" * 30)]
    rows = [(d, t, "en", "s", len(t or ""), "z", 9, 3, None, 5, "c") for d, t in texts]
    for name, table in (("odd", spark.createDataFrame(rows, schema)), ("none", spark.createDataFrame([], schema))):
        docs = table
        for stage, run in corpus_pipeline.STAGES:
            run(spark, docs, sf).write.parquet(str(tmp_path / name / stage))
            docs = spark.read.parquet(str(tmp_path / name / stage))
            if stage != "bpe_encoding":
                assert docs.columns == table.columns
        got = {r["doc_id"]: r["n_tokens"] for r in docs.collect()}
        if name == "none":
            assert got == {}
        else:
            assert {1, 3, 4, None} == set(got) and got[1] == 0 and got[3] > 100_000
