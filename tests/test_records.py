"""Stems, contexts, chunks, landing, caches, reports and jobs against small cases and plain Python."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from folioflow import jobs, settings
from folioflow.functions import payloads
from folioflow.functions.stemming import english, stem
from folioflow.operators import cache, chunks, documents, percentiles, replies, resolver, retrieval, tables
from folioflow.sources import configs, landing, nested, sinks


def test_stems():
    pairs = "consigned consign consistency consist generously generous hopping hop hoping hope relational relat happy happi cries cri dying die news news knives knive proceed proceed adjustable adjust revenues revenu companies compani licensing licens agreed agre communication communic gas gas rational ration".split()
    assert [(w, stem(w)) for w in pairs[::2]] == list(zip(pairs[::2], pairs[1::2], strict=True))
    assert english("the") == "" and english("a") == "" and english("sky") == "sky" and english("é") == "é"


def test_stemmed_search(spark):
    rows = spark.createDataFrame([(1, "The licensing of the companies"), (2, "company licenses; the bank of america"), (3, "bank america"), (4, None)], "chunk_id long, text string")
    rows = retrieval.with_tokens(rows, stemmed=True)

    def fit(query):
        return [r[0] for r in rows.filter(retrieval.web_condition(F.col("tokens"), query, True)).orderBy("chunk_id").collect()]

    assert fit("the license companies") == [1, 2] and fit('"bank of america"') == [2] and fit("bank -license") == [3]
    assert fit("the of") == [] and fit("banks OR licensed") == [1, 2, 3] and fit("'") == []


def test_bm25_and_nearest(spark):
    rows = spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, None), (4, "")], "id long, text string")
    assert [r[0] for r in retrieval.bm25(rows, "id", ["a", "b", "a"], 5).collect()] == [1, 2]
    assert retrieval.bm25(rows.filter("1 = 0"), "id", ["a"], 5).count() == 0
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [2.0, 0.1])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], "query_id long, query array<float>")
    assert [(r["query_id"], r["vec_id"], r["rank"]) for r in retrieval.dense_topk(q, v, 5).orderBy("rank").collect()] == [(7, 1, 1), (7, 4, 2)]
    assert retrieval.dense_topk(q.filter("1 = 0"), v, 5).count() == 0


def plain_admitted(hits, budget, cap):
    seen, total, now, opened = {}, 0, None, 0
    for step, rank, i, tokens, at, anchor in sorted(hits):
        if step != now:
            now, opened = step, len(seen)
        if (opened if anchor else len(seen)) >= budget or (cap is not None and total + tokens > cap):
            continue
        if i not in seen:
            seen[i] = at
            total += tokens
    return len(seen), total, ",".join(i for i, _ in sorted(seen.items(), key=lambda x: (x[1], x[0])))


@pytest.mark.parametrize("cap", [None, 150])
def test_contexts(spark, cap):
    r = random.Random(3)
    rows = [(g, r.randrange(4), k, f"h{r.randrange(9)}", 0, 0, False) for g in range(40) for k in range(r.randrange(1, 15))]
    rows = [(g, s, k, i, 10 + int(i[1]) * 7, 50 - int(i[1]), s < 2) for g, s, k, i, *_ in rows]
    got = documents.admitted(spark.createDataFrame(rows, "g long, step int, rank int, id string, tokens int, at int, anchor boolean"), "g", 4, cap).collect()
    groups = {g: [x[1:] for x in rows if x[0] == g] for g in {x[0] for x in rows}}
    assert {x["g"]: tuple(x)[1:] for x in got} == {g: plain_admitted(h, 4, cap) for g, h in groups.items()}


PAGE = "<html><ix:header>hidden</ix:header><p>Cover page words here</p><p>Item 1. Business</p><p>{}</p><table><tr><td></td><td>2023</td><td>2022</td></tr><tr><td>Sales</td><td>$</td><td>1,0</td><td>5</td></tr><tr><td>Cost &amp; more</td><td>7</td><td>8</td></tr></table><table><tr><td>only text</td></tr></table><p>Item 2. Properties</p><p>{}</p></html>"


def test_parsed_pages_and_chunks(spark):
    words = "We make things and sell them. " * 30
    pages = spark.createDataFrame([(1, PAGE.format(words, words)), (2, None)], "page_id long, html string")
    got = {r["page_id"]: r for r in documents.parsed(pages).collect()}
    text, blocks = got[1]["text"], got[1]["blocks"]
    assert [b["kind"] for b in blocks] == ["prose", "table", "prose"] and got[2]["text"] == "" and got[2]["blocks"] == []
    assert "hidden" not in text and text[blocks[1]["start"] : blocks[1]["end"]].startswith("|  | 2023 | 2022 |") and "| Cost & more | 7 | 8 |" in text and "only text" in text
    docs = documents.parsed(pages).select(F.concat(F.lit("a"), "page_id").alias("accession"), F.lit("0000000001").alias("cik"), F.lit("x").alias("company"), F.lit("10-K").alias("form"), F.lit("2024-02-01").cast("date").alias("filed"), "text", "blocks")
    rows = chunks.assembled(docs, 60, 10, 5).orderBy("char_start").collect()
    assert chunks.assembled(docs, 60, 10, 5).schema.simpleString() == "struct<" + ",".join(f"{c.split()[0]}:{c.split()[1]}" for c in chunks.COLUMNS.split(", ")) + ">"
    assert all(text[r["char_start"] : r["char_end"]] == r["text"] for r in rows) and {r["fiscal_year"] for r in rows} == {2023}
    assert rows[0]["chunk_id"] == "a1::front::c1" and rows[0]["section"] == "Unknown" and [r["chunk_type"] for r in rows].count("table") == 1
    assert {(r["item_number"], r["section"]) for r in rows[1:]} == {("1", "Business"), ("2", "Properties")}
    table = next(r for r in rows if r["chunk_type"] == "table")
    assert table["item_number"] == "1" and table["chunk_id"].startswith("a1::item1::c")
    assert len({r["chunk_id"] for r in rows}) == len(rows) and not any("Item 2" in r["text"] and r["item_number"] == "1" for r in rows)
    assert chunks.assembled(docs.filter("1 = 0")).count() == 0


def test_landing_and_indexes(spark, tmp_path):
    root, schema = f"file://{tmp_path}/archive", "prefix string, filename string, content string"
    first = spark.createDataFrame([("a/b c+%", "f", "1"), ("q", "f", "1"), ("q", "g", "2")], schema)
    assert {tuple(r) for r in landing.land(root, first).collect()} == {("a/b c+%", "landed"), ("q", "landed")}
    more = spark.createDataFrame([("q", "f", "1"), ("q", "h", "3")], schema)
    assert [tuple(r) for r in landing.land(root, more).collect()] == [("q", "conflict")]
    assert [tuple(r) for r in landing.land(root, more, overwrite=True).collect()] == [("q", "overwritten")]
    assert sorted(tuple(r) for r in landing.manifest(spark, root).select("prefix", "filename").collect()) == [("a/b c+%", "f"), ("q", "f"), ("q", "h")]
    assert [r[0] for r in landing.prefixes(spark, root).collect()] == ["a/b c+%", "q"]
    assert landing.land(root, first.filter("1 = 0")).count() == 0 and landing.manifest(spark, root + "x").count() == 0
    assert landing.index_path("base", datetime.date(2024, 10, 2)) == "base/2024/QTR4/master.20241002.idx"
    assert landing.daily_index(spark, f"file://{tmp_path}/none.idx").count() == 0


def test_caches(spark, tmp_path):
    path, calls = f"file://{tmp_path}/cache", []

    def compute(rows):
        calls.append(1)
        return rows.withColumn("v", F.col("k") * 2)

    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 4)], "d string, k long")
    got = cache.read_through(rows, "d", path, compute, 0, 10)
    assert sorted((r["k"], r["hit"], r["v"]) for r in got.collect()) == [(1, False, 2), (1, False, 2), (2, False, 4), (3, False, 6), (4, False, 8)]
    again = cache.read_through(rows, "d", path, compute, 5, 10)
    assert sorted((r["k"], r["hit"]) for r in again.collect()) == [(1, True), (1, True), (2, True), (3, False), (4, False)]
    late = cache.read_through(rows, "d", path, compute, 10, 10)
    assert sum(r["hit"] for r in late.collect()) == 0
    assert cache.hit_rate(rows.limit(0).withColumn("hit", F.lit(True))).first()["hit_rate"] == 0


def test_order_statistics(spark):
    r = random.Random(1)
    rows = [(g, None if r.random() < 0.1 else r.choice([r.random() * 100, float(r.randrange(4))])) for g in ("x", "y", None) for _ in range(r.randrange(1, 400))] + [("one", 5.0), ("none", None)]
    got = {x["g"]: (x["p50"], x["p95"]) for x in percentiles.latency(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    for g in {g for g, _ in rows} - {"none"}:
        v = sorted(x for k, x in rows if k == g and x is not None)
        assert got[g] == (pytest.approx(statistics.median(v)), v[round(0.95 * (len(v) - 1))])
    assert "none" not in got


def test_resolver_golden(spark):
    d = datetime.date
    obs = [
        ("c", "Rev", "USD", 100, d(2022, 1, 1), d(2022, 12, 31), "10-K", d(2023, 2, 1), "a1"),
        ("c", "Rev", "USD", 101, d(2022, 1, 1), d(2022, 12, 31), "10-K", d(2024, 2, 1), "a2"),
        ("c", "Rev", "USD", 99, d(2022, 1, 1), d(2022, 12, 31), "8-K", d(2022, 2, 1), "a0"),
        ("c", "Rev", "USD", 25, d(2022, 10, 1), d(2022, 12, 31), "10-K", d(2023, 2, 1), "a1"),
        ("c", "Sales", "USD", 7, d(2022, 1, 3), d(2023, 1, 1), "10-Q", None, "b1"),
        ("c", "Assets", "USD", 70, None, d(2023, 1, 29), "10-K", None, "b1"),
    ]
    obs = [(*o, i) for i, o in enumerate(obs)]
    o = spark.createDataFrame(obs, "cik string, tag string, unit string, val long, start_d date, end_d date, form string, filed date, accn string, seq int").withColumn("val", F.col("val").cast("decimal(38,4)"))
    s = spark.createDataFrame([("revenue", "duration", "USD", "Rev", 0), ("revenue", "duration", "USD", "Sales", 1), ("assets", "instant", "USD", "Assets", 0)], "field string, period string, unit string, tag string, pref int")
    got = {(r["field"], r["fy"]): (int(r["val"]), r["tag"], r["accn"], r["restated"], r["filed"]) for r in resolver.resolved(o, s).collect()}
    assert got == {("revenue", 2022): (100, "Rev", "a1", True, d(2023, 2, 1)), ("assets", 2023): (70, "Assets", "b1", False, d(2023, 1, 29))}
    pins = spark.createDataFrame([("c", 2022, "a2")], "cik string, fy int, pin string")
    assert {int(r["val"]) for r in resolver.resolved(o, s, pins).filter("fy = 2022").collect()} == {101}
    assert sorted(int(r["val"]) for r in resolver.resolved_candidates(o, s).filter("field = 'revenue'").collect()) == [7, 100]
    wanted = spark.createDataFrame([("a1", 1900), ("zz", 1999)], "accn string, fallback int")
    assert {r["accn"]: r["fy"] for r in resolver.reported_year(o, wanted, "seq").collect()} == {"a1": 2022, "zz": 1999}


def test_payloads_reports_and_settings(spark, tmp_path):
    assert payloads.canonical_json({"b": 1, "a": [1, None]}) == b'{"a":[1,null],"b":1}'
    schema = {"type": "object", "additionalProperties": False, "properties": {"type": {"type": ["string", "null"]}, "n": {"type": "array", "items": {"type": "number"}}}}
    assert payloads.dialect(schema) == {"type": "OBJECT", "properties": {"type": {"type": "STRING", "nullable": True}, "n": {"type": "ARRAY", "items": {"type": "NUMBER"}}}}
    assert payloads.unpacked(payloads.packed([0.5, -2.0])) == [0.5, -2.0] and len(payloads.packed(range(384))) == 1536
    assert sinks.merged_section("", "m", "x") == "<!-- m -->\nx\n<!-- /m -->\n"
    assert sinks.merged_section("a\n<!-- m -->\nold\n<!-- /m -->\nb", "m", "new") == "a\n<!-- m -->\nnew\n<!-- /m -->\nb"
    report = spark.createDataFrame([("b|c", 2, 0.5), ("a", 1, None)], "k string, n int, x double")
    text = sinks.write_report(report, ["k"], str(tmp_path / "r.md"), "t")
    assert "| a | 1 |  |\n| b\\|c | 2 | 0.5000 |" in text
    assert sinks.markdown_table(report, ["k"], 1).first()[0].endswith("and 1 more")
    assert not sinks.push(spark.createDataFrame([(1,)], "other int"), str(tmp_path / "x"))
    for bad in ({"contact": "nobody"}, {"contact": "a@b.org", "overlap": 512}):
        with pytest.raises(ValueError):
            settings.Settings(**bad)
    ties = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c")], "k int, at int, v string")
    assert [tuple(r) for r in tables.latest(ties, ["k"], "at").collect()] == [(1, 5, "b")]


def test_jobs(spark, tmp_path):
    words = "Revenue grew and companies paid their licenses. " * 20
    docs = spark.createDataFrame([("a", "1", "x", "10-K", datetime.date(2024, 3, 1), "Item 1. Business\n" + words, None)], "accession string, cik string, company string, form string, filed date, text string, blocks array<struct<kind:string,start:int,end:int>>")
    docs.write.parquet(f"{tmp_path}/in/filings.parquet")
    cards = spark.createDataFrame([("a", "m", 1, [("revenue", "exact"), ("assets", "wrong")])], "accession string, model string, evaluated_at int, scores array<struct<field:string,verdict:string>>")
    cards.write.parquet(f"{tmp_path}/in/scorecards.parquet")
    run = lambda *a: jobs.main([a[0], "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/{a[0]}", *a[1:]], spark)
    assert run("parse_filing") == 0 and run("index_corpus") == 0 and run("seed_sample") == 0
    assert run("demo", "--query", "license company") == 0 and spark.read.parquet(f"{tmp_path}/demo").count() >= 1
    assert run("run_extraction", "--floor", "0.9") == 1 and run("run_extraction", "--floor", "0") == 0
    with pytest.raises(ValueError):
        run("index_corpus", "--overlap", "600")


def test_tag_maps(spark):
    assert configs.annual_days("annual_duration_days: {max: 390}") == (340, 390) and configs.annual_days("") == (340, 400)
    assert configs.tag_specs(spark, '{"fields": {}}').count() == 0 and configs.tag_specs(spark, "").count() == 0
    if configs.yaml:
        text = "fields:\n  sales:\n    period: instant\n    units: [EUR]\n    tags:\n      - B   # first\n      - A\n      - B\n"
        assert sorted(tuple(r) for r in configs.tag_specs(spark, text).collect()) == [("sales", "instant", "EUR", "A", 1), ("sales", "instant", "EUR", "B", 0)]
    with pytest.raises(ValueError, match="period"):
        configs.tag_specs(spark, '{"fields": {"x": {"period": "month", "tags": ["T"]}}}')
    with pytest.raises(ValueError, match="mapping"):
        configs.parsed("[1]")


def test_replies_are_asked_for_once_more(spark):
    asked = spark.createDataFrame([(1, '{"net_income": 3}'), (2, "{"), (3, None), (4, '{"total_revenue": 9')], "k int, reply string")
    first = nested.completions(asked, "k", "reply", 2020)
    assert sorted(r.k for r in replies.unfit(first, "k").collect()) == [2, 3, 4]
    second = nested.completions(spark.createDataFrame([(2, '{"total_revenue": 8, "fiscal_year": 2019}'), (4, "no")], "k int, reply string"), "k", "reply", 2020)
    got = {r.k: r for r in replies.settled(first, second, "k").collect()}
    assert [(got[k].ok, got[k].attempts, got[k].error is None) for k in (1, 2, 3, 4)] == [(True, 1, True), (True, 2, True), (False, 1, False), (False, 2, False)]
    assert got[2].total_revenue == 8 and got[2].fiscal_year == 2019 and got[4].total_revenue is None and got[3].fiscal_year == 2020
    assert replies.settled(first.limit(0), second, "k").count() == 0
