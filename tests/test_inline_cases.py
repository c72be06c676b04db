"""Cases that the tables do not hold, for operators whose queries run on the tables."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow import jobs
from folioflow.functions import sections
from folioflow.functions import text as T
from folioflow.operators import alerts, chunks, documents, headings, html_tables, intervals
from folioflow.sources import configs


def test_regions_of_pages_without_headings_and_with_items_out_of_order(spark):
    long = "Front\nPART I\nItem 1. Business\ntext é😀\nItem 1\n ITEM 1A - Risk Factors.\nsee Item 9 there\nPART II\nItem 1 Legal\nend"
    rows = [(1, "10-K", long), (2, "10-Q", "Item 2: MD\nItem 1: late"), (3, "10-K", ""), (4, "10-K", "no heading")]
    got = headings.item_regions(spark.createDataFrame(rows, "doc_id int, form string, text string"))
    assert sorted(map(tuple, got.select("doc_id", "start", "end", "item", "title", "section").collect())) == [
        (1, 13, 45, "1", "Business", "Business"), (1, 45, 95, "1A", "Risk Factors", "Risk Factors"), (1, 95, 111, "1", "Legal", "Business"),
        (2, 0, 23, "2", "MD", "Management's Discussion and Analysis"),
    ]


def test_sections_of_odd_items(spark):
    rows = [("1A", "10-K"), (" item 7. ", "10-K/A"), ("2", "10-Q"), ("8", "10-Q"), ("99", "10-K"), (None, "10-K"), ("10", "10-k"), ("x", "10-K")]
    s = sections.section(F.col("item"), F.col("form"))
    got = spark.createDataFrame(rows, "item string, form string").select(s.alias("s"), sections.is_primary(s).alias("p")).collect()
    analysis = "Management's Discussion and Analysis"
    want = [("Risk Factors", True), (analysis, True), (analysis, True), ("Unknown", False), ("Unknown", False), ("Unknown", False), ("Directors and Corporate Governance", False), ("Unknown", False)]
    assert list(map(tuple, got)) == want


def test_tag_maps_of_rows_and_of_one_text_agree(spark):
    text = '{"fields":{"sales":{"period":"duration","units":["USD","EUR"],"tags":["Revenues","Sales","Revenues"]},"assets":{"period":"instant","tags":["Assets","AssetsNet"]}}}'
    want = [("sales", "duration", u, t, i) for i, t in enumerate(["Revenues", "Sales"]) for u in ("USD", "EUR")] + [("assets", "instant", "USD", t, i) for i, t in enumerate(["Assets", "AssetsNet"])]
    assert sorted(map(tuple, configs.tag_specs(spark, text).collect())) == sorted(want)
    rows = spark.createDataFrame([(1, text), (2, None), (3, "{}"), (4, "no json")], "id int, body string")
    assert sorted(map(tuple, configs.tag_maps(rows, "id").collect())) == sorted((1, *w) for w in want)
    wrong = spark.createDataFrame([(1, '{"fields":{"a":{"period":"later","tags":["x"]}}}')], "id int, body string")
    with pytest.raises(Exception, match="the period is duration or instant"):
        configs.tag_maps(wrong, "id").collect()


def test_figures_in_contexts(spark):
    rows = [(1234000.0, "sales of 1,234 thousand"), (5500000.0, "nothing"), (None, "x"), (-42.0, "a loss of (42)"), (1234.5, "1234"), (0.0, "0")]
    found = F.exists(T.figure_forms(F.col("truth")), lambda f: F.col("context").contains(f))
    got = [r[0] for r in spark.createDataFrame(rows, "truth double, context string").select(found).collect()]
    assert got == [True, False, False, True, False, False]


def test_layout_tables(spark):
    page = "<table><tr><td>a</td></tr></table><table><tr><td>x</td><td>1,000</td></tr><tr><td>y</td><td>(2.5)</td></tr></table><table><tr><td>p</td><td>q</td></tr><tr><td>r</td><td>s</td></tr></table>"
    got = html_tables.extracted(spark.createDataFrame([(1, page), (2, None)], "page_id long, html string"))
    assert sorted(map(tuple, got.select("page_id", "ordinal", "layout").collect())) == [(1, 0, True), (1, 1, False), (1, 2, True)]


def test_alerts_that_hold_and_that_others_inhibit(spark):
    states = [("x", 0, True), ("x", 60, True), ("x", 600, True), ("x", 660, False), ("x", 720, True), ("y", 0, False), ("y", 60, True), ("y", 120, True)]
    held = alerts.held(spark.createDataFrame(states, "rule string, at int, firing boolean"), "rule", "at", "firing", 300)
    assert list(map(tuple, held.collect())) == [("x", 0, 600)]
    own = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p1"), (4, None)], "id int, platform string")
    assert sorted(r["id"] for r in alerts.inhibited(own, spark.createDataFrame([("p1",), (None,)], "platform string"), ["platform"]).collect()) == [2, 4]


def test_bytes_of_unknown_encoding(spark):
    rows = [(1, b"caf\xc3\xa9"), (2, b"caf\xe9 \x93x\x94"), (3, b""), (4, None), (5, b"\x81\x93")]
    got = spark.createDataFrame(rows, "id int, raw binary").select(T.decoded(F.col("raw"))).collect()
    assert [r[0] for r in got] == ["café", "café “x”", "", None, "\x81\x93"]


def test_stale_chunks(spark):
    rows = [("a", "one two three"), ("b", "one two three"), ("c", "x"), ("d", "y"), ("e", "z")]
    made = [("a", 0, 3, "one"), ("a", 4, 7, "two"), ("b", 0, 3, "one"), ("b", 8, 13, "four!"), ("d", 0, 1, "y"), ("gone", 0, 1, "q"), ("e", 0, 0, None)]
    chunks_ = spark.createDataFrame(made, "accession string, char_start int, char_end int, text string")
    got = chunks.stale(chunks_, spark.createDataFrame(rows, "accession string, text string"))
    assert sorted(map(tuple, got.collect())) == [("b", 2, 1), ("e", 1, 1), ("gone", 1, 1)]


def test_no_frame_of_an_increase_slides(spark):
    """A sliding frame costs each row all rows of its window: quadratic in how dense the samples are."""
    samples = spark.createDataFrame([("a", 1, 2.0)], "k string, at long, v double")
    plan = alerts.increase(samples, "k", "at", "v", 500)._jdf.queryExecution().optimizedPlan().toString()
    assert "RangeFrame, -" not in plan


def test_windows_dealt_by_stretches_are_those_of_whole_keys(spark):
    r = random.Random(3)
    rows = sorted({(k, r.randrange(-4000, 40000)): r.choice([0.1, 2.5, 7.0]) * r.randrange(50) for k in ("a", "b", None) for _ in range(300)}.items(), key=str)
    samples = spark.createDataFrame([(k, at, v) for (k, at), v in rows], "k string, at long, v double")
    got = {(x["k"], x["at"]): x["increase"] for x in alerts.increase(samples, "k", "at", "v", 500).collect()}
    want = {}
    for k in ("a", "b", None):
        own = sorted((at, v) for (q, at), v in rows if q == k)
        for at, _ in own:
            inside = [v for t, v in own if at - 500 < t <= at]
            want[k, at] = sum(y - x if y >= x else y for x, y in zip(inside, inside[1:], strict=False))
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in got)
    total = {(x["k"], x["at"]): x["t"] for x in intervals.running_total(samples, "k", "at", "v", 700, "t").collect()}
    assert total.keys() == want.keys()
    assert all(abs(total[k, at] - sum(v for (q, t), v in rows if q == k and t <= at)) < 1e-6 for k, at in total)
    per = samples.select("k", F.col("at").alias("step"), F.lit(2).alias("total"), (F.col("v") > 60).cast("int").alias("bad"))
    burn = {(x["k"], x["step"]): x["burn"] for x in alerts.burn_rates(per, "k", 900, 0.9).collect()}
    for k, at in want:
        bad = [v > 60 for (q, t), v in rows if q == k and at - 900 < t <= at]
        assert abs(burn[k, at] - sum(bad) / (2 * len(bad)) / 0.1) < 1e-5


def test_a_sweep_of_budgets_is_each_budget_alone(spark, tmp_path):
    r = random.Random(8)
    rows = [(q, r.randrange(3), k, f"c{r.randrange(12)}", r.randrange(1, 90), r.randrange(500), k % 5 == 0) for q in "abc" for k in range(20)]
    hits = spark.createDataFrame(rows, "question string, step int, rank int, id string, tokens int, at int, anchor boolean")
    hits.write.parquet(f"{tmp_path}/in/hits.parquet")
    assert jobs.main(["sweep_context_budget", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out", "--top", "4", "--cap", "200"], spark) == 0
    got = {x["budget"]: (x["chunks"], x["tokens"]) for x in spark.read.parquet(f"{tmp_path}/out").collect()}
    for budget in range(1, 5):
        alone = documents.admitted(hits, "question", budget, 200).collect()
        assert got[budget] == (sum(x["n"] for x in alone) / 3, sum(x["tokens"] for x in alone) / 3)
    assert set(got) == {1, 2, 3, 4}
