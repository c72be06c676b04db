"""Plain tables are read without a parser; the rows are those of the parser."""

import random

from folioflow.operators import html_tables


def parsed(page):
    p = html_tables._Tables()
    p.feed(page)
    p.close()
    return p.done


def test_plain_pages_give_the_tables_of_the_parser(monkeypatch):
    rnd = random.Random(1)
    cell = lambda: rnd.choice(["", " a\n b ", "1,234", "$", "%", "x > y", "\u00a0z"])
    pages = []
    for _ in range(300):
        tables = ["<table>" + "".join("<tr>" + "".join(f"<td>{cell()}</td>" for _ in range(rnd.randrange(4))) + "</tr>" for _ in range(rnd.randrange(4))) + "</table>" for _ in range(rnd.randrange(3))]
        pages.append("<p>lines</p>" + rnd.choice(["", "text", "</p>"]).join(tables))
    want = [parsed(p) for p in pages]
    for p in ("<table><tr><td>a<table></table></td></tr></table>", "<table><tr><td>a &amp; b</td></tr>", "<table><tr><td colspan=2>a</td></tr></table>", "<TABLE><tr><td>a</table>", "<table><td>a</td></table>"):
        assert html_tables.tables_of(p) == parsed(p)

    def never(self, data):
        raise AssertionError("the parser ran")

    monkeypatch.setattr(html_tables._Tables, "feed", never)
    assert [html_tables.tables_of(p) for p in pages] == want
