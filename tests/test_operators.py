import pytest

from folioflow.operators import control, documents


def test_windows_cover_and_overlap():
    text = " ".join(f"Sentence number {i} has some words in it." for i in range(60))
    got = documents.windows(text, 60, 15, 5)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(n <= 60 for _, _, n in got) and all(b[0] < a[1] for a, b in zip(got, got[1:], strict=False))
    assert documents.windows("", 60, 15) == [] and documents.windows("few words", 60, 15) == []
    with pytest.raises(ValueError):
        documents.windows("x", 10, 10)


def test_flat_text():
    assert documents.flat_text("<head><title>t</title></head><p>a &amp; b</p><script>x()</script><div> c\n d</div>") == "t\na & b\nc d"
    assert documents.flat_text(None) == ""


def test_budget_skips_what_does_not_fit(spark):
    rows = [("g", 1, 10, 5), ("g", 2, 11, 9), ("g", 3, 12, 4), ("g", 4, 13, 1), ("g", 5, 14, 1)]
    hits = spark.createDataFrame(rows, "g string, rank int, id long, tokens int").selectExpr("*", "1 AS step", "id AS at", "false AS anchor")
    got = documents.admitted(hits, "g", 3, 10).collect()
    assert [(r["tokens"], r["ids"]) for r in got] == [(10, "10,12,13")]


def test_token_bucket_and_breaker(spark):
    e = spark.createDataFrame([("k", t, 1.0) for t in (0.0, 0.0, 0.0, 1.0, 9.0)], "key string, t double, n double")
    assert [r["wait"] for r in control.token_bucket_waits(e, 2.0).orderBy("t", "wait").collect()] == [0.0, 0.0, 0.5, 0.0, 0.0]
    e = spark.createDataFrame([("k", float(t), ok) for t, ok in [(0, False), (1, False), (2, True), (7, False), (8, True), (13, True), (14, False)]], "key string, t double, ok boolean")
    assert [r["state"] for r in control.breaker_states(e, 2, 5.0).orderBy("t").collect()] == ["closed", "closed", "open", "half_open", "open", "half_open", "closed"]
