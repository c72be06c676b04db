"""Tables, windows, cover density and search lines against small cases and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.operators import documents, html_tables, retrieval


def test_grid_spans_signs_and_padding():
    page = "<table><tr><td></td><td colspan=2>2023</td><td>2022</td></tr><tr><td>Americas</td><td>$</td><td>1,0</td><td>5|6</td></tr><tr><td rowspan=2>Eur</td><td></td><td>7</td><td>8</td><td>%</td></tr><tr><td>1</td></tr></table>"
    (t,) = html_tables.tables_of(page)
    assert html_tables.grid(t) == [["", "2023", "2022"], ["Americas", "$1,0", "5|6"], ["Eur", "7", "8%"], ["Eur", "1", ""]]
    assert html_tables.markdown(html_tables.grid(t)).splitlines()[1:3] == ["| --- | --- | --- |", "| Americas | $1,0 | 5\\|6 |"]
    assert not html_tables.is_layout(t)


def test_signs():
    assert html_tables.with_signs([(0, "$"), (2, "5"), (3, "%")]) == ["$", "5%"]
    assert html_tables.with_signs([(0, "%"), (1, "a")]) == ["%", "a"]
    assert html_tables.with_signs([(0, "$"), (1, "5"), (2, "%"), (3, "€"), (4, "€"), (5, "7")]) == ["$5%", "€", "€7"]
    assert html_tables.with_signs([(2, "%"), (3, "a")]) == ["a"]


def test_cells_over_rows_and_limits():
    (t,) = html_tables.tables_of("<table><tr><td rowspan=3>a</td><td>b</td><td rowspan=2>c</td></tr><tr><td>d</td></tr><tr></tr><tr><td>e</td></tr></table>")
    assert html_tables.placed(t) == [{0: "a", 1: "b", 2: "c"}, {0: "a", 1: "d", 2: "c"}, {0: "a"}, {0: "e"}]
    rows = [[(str(i), 1, 1), ("x", 1, 1)] for i in range(500)]
    assert len(html_tables.grid(rows)) == 400 and len(html_tables.grid(rows, None, None)) == 500


def test_empty_unclosed_and_nested_tables():
    assert html_tables.tables_of(None) == [] and html_tables.grid([]) == [] and html_tables.markdown([]) == ""
    outer, inner = html_tables.tables_of("<table><tr><td>a<table><tr><td colspan=x>b</table></td><td>c")
    assert outer == [[("a b", 1, 1), ("c", 1, 1)]] and inner == [[("b", 1, 1)]]
    assert html_tables.placed([[("a", 64, 64)]]) == [{0: "a"}]


@pytest.mark.parametrize("seed", range(5))
def test_windows_lose_no_word(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["word ", "End. Next ", "\n", "\n\n", "é😀 ", "x" * 30 + " "]) for _ in range(800))
    got = documents.windows(text, 64, 16, 0)
    covered = set()
    for a, b, _ in got:
        assert text[a:b] == text[a:b].strip()
        covered |= set(range(a, b))
    assert all(i in covered for i, c in enumerate(text) if not c.isspace())


def _covers(tokens, terms):
    spans = [(a, b) for a in range(len(tokens)) for b in range(a, len(tokens)) if set(terms) <= set(tokens[a : b + 1])]
    least = [(a, b) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)]
    return sum(0.1 / (1 + sum(t not in terms for t in tokens[a : b + 1])) for a, b in least)


def test_cover_density_is_the_sum_over_shortest_covers(spark):
    r = random.Random(1)
    rows = [(i, [r.choice("abcdxyz") for _ in range(r.randrange(0, 16))]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, tokens array<string>")
    for terms in (["a"], ["a", "b"], ["a", "b", "c"]):
        got = {x["i"]: x["s"] for x in df.select("i", retrieval.cover_density(F.col("tokens"), terms).alias("s")).collect()}
        assert got == pytest.approx({i: _covers(t, terms) for i, t in rows})


def test_search_lines(spark):
    df = spark.createDataFrame([(1, "net income rose".split()), (2, "income net".split()), (3, "loss fell".split())], "i int, tokens array<string>")

    def found(query):
        return [x["i"] for x in df.filter(retrieval.web_condition(F.col("tokens"), query)).orderBy("i").collect()]

    assert found("net income") == [1, 2] and found('"net income"') == [1] and found("income -rose") == [2]
    assert found("rose OR loss") == [1, 3] and found("...") == [] and found("") == [] and found('-"net income" OR') == [2, 3]
