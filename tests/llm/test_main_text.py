"""Main texts of written pages, and of the given ones against their article elements."""

import html
import re

import pytest

from folioflow.llm import main_text

LONG = "A sentence that is long enough to be the text of an article about nothing at all."
PAGES = {
    "template": (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><!-- ad --><div class=\"ad\">{LONG} Buy.</div><article><h1>Ha.</h1><p><b>Head.<br><p>Ha.</p><p>{LONG}</p></article><footer>&copy; {LONG}</footer></body></html>", f"Ha. Head. Ha. {LONG}"),
    "one word beside a long advert": (f'<body><div class="ad">{LONG} {LONG}</div><article><h1>Ha.</h1></article><footer>{LONG}</footer>', "Ha."),
    "inline tags and references": ("<article><p>a<b>b</b>c &lt;d&gt;&nbsp;&amp;amp; \n\t e<wbr>f<br>g</p></article>", "abc <d> &amp; ef g"),
    "comments, sidebar, notice, form": (f'<body><header><h2>{LONG}</h2></header><div class="cookie-notice">{LONG}</div><main><article><header><h1>Title</h1></header><p>{LONG}</p><aside>{LONG}</aside><form><p>{LONG}</p><input></form><section id="comments"><article class="comment"><p>{LONG}</p></article></section></article></main><div id="sidebar"><p>{LONG}</p></div></body>', f"Title {LONG}"),
    "no article element": (f'<body class="has-sidebar"><div id="top-menu"><a>One</a> <a>Two</a></div><div class="links"><p><a>x</a> <a>y</a> <a>z</a> <a>w</a></p></div><div id="content"><h1>Title</h1><p>{LONG}</p><p>No.</p><div><p>{LONG} {LONG}</p></div></div><div class="commentlist"><p>{LONG}</p></div></body>', f"Title {LONG} No. {LONG} {LONG}"),
    "cut off": (f"<article><p>{LONG}</p><p>And th", f"{LONG} And th"),
    "left open before the article": (f'<div class="ad"><p>{LONG}<article><p>Text.</p></article>', "Text."),
    "wrong nesting": ("<article><p><b>a</p></b></div></span><p>b<div>c</p></article> <p>d", "a b c"),
    "header of an entry": (f'<div class="post"><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p></div>', f"Title {LONG}"),
    "no markup": ("just  text", "just text"),
    "script left open": ("<article><p>a</p></article><script>var x = 1", "a"),
    "nothing": ("", ""),
    "only a menu": ("<nav>a</nav>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, want = PAGES[name]
    assert main_text.main_text(page) == want


def test_pieces_do_not_matter(monkeypatch):
    pages = [p for p, _ in PAGES.values()]
    whole = [main_text.main_text(p) for p in pages]
    for piece in (1, 7, 64):
        monkeypatch.setattr(main_text, "PIECE", piece)
        assert [main_text.main_text(p) for p in pages] == whole


def test_smoothing_and_clusters():
    assert main_text.smoothed([5.0] * 9) == pytest.approx([5.0] * 9)
    lines = [("x", 5, ())] * 6 + [("y" * 80, 1, ())] * 4 + [("x", 5, ())] * 6
    found = main_text.clusters(lines)
    assert set(range(6, 10)) <= set(found) and 0 not in found and 15 not in found and main_text.clusters([]) == []


def test_tables(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", PAGES["template"][0], None), (3, "u", PAGES["template"][0], None), (None, "v", "<p>" + "long words " * 300_000, "y")]
    got = {r.page_id: r for r in main_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert (got[1].text, got[1].n_chars, got[1].url) == ("", 0, None) and got[2].text == ""
    assert got[3].text == PAGES["template"][1] and got[None].n_chars == 11 * 300_000 - 1
    assert main_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_given_pages(spark):
    """The given pages keep their text in one article element without inner blocks other than p, h1 and br."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in main_text.extracted(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        text = re.sub("<[^>]*>", lambda t: "" if t[0] in ("<b>", "</b>") else " ", inner)
        assert got[r.page_id] == " ".join(html.unescape(text).split())
