"""The main text of HTML pages: parser events become lines, smoothed text-to-tag ratios cluster them into content.

The standard library's parser is fed in pieces. Block elements end lines; a line knows its text, how many tags it took
and its containers. The ratio of characters to tags is smoothed with a Gaussian over neighbouring lines and cut at its
standard deviation; lines above it are content. Content decides which container holds the article: the page's article or
main element if content lies in it, else the lowest container with nearly all of it. Of that container every line counts,
however short, for a threshold alone would lose short paragraphs. Navigation, headers, footers, asides, forms, notices,
adverts and comments are told by element, role and the words of class and id; they neither score nor count.

Scale: pages are independent, one scan without a shuffle; a worker holds one Arrow batch and the lines of one page.

Defined cases: null and empty pages and pages without text give an empty text; markup that is cut off, unclosed or
wrongly nested is read as far as it goes; pages of any length are read whole; repeated rows give repeated rows; an empty
table gives none; other columns are not read. White space is what Python's str.split() takes for it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: What the elements of HTML are.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark meter picture q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style noscript template iframe object svg math canvas audio video select button textarea datalist title".split())
ASIDE = frozenset("nav aside footer form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of class or id that mark what is no article.
WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion nav navbar navigation menu menus breadcrumb breadcrumbs
    header masthead topbar footer bottombar sidebar sidebars aside rail cookie cookies consent gdpr notice notices notification alert alerts banner popup modal overlay
    newsletter subscribe subscription signup login share sharing social comment comments commentlist respond disqus discussion replies reply form search searchbox
    copyright disclaimer related recommended recommendations pagination pager skip""".split()
)
COMMENTS = frozenset("comment comments commentlist respond disqus discussion replies reply".split())
ARTICLE = frozenset("article main".split())
OWN_HEADER = frozenset("article entry post story content".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
PIECE = 1 << 16
SIGMA = 1.0
SHARE = 0.8


def _words(attrs: list[tuple[str, str | None]]) -> set[str]:
    return {w.lower() for name, value in attrs if name in ("class", "id") and value for token in value.split() if not re.match(r"(?:has|no|with|without|is)[-_]", token) for w in _WORD.findall(token)}


class Lines(HTMLParser):
    """Collects (text, tags, path) of each line outside what is no article; path has the numbers of its containers."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        self.articles: list[int] = []
        self._open: list[tuple[str, int, str]] = []  # element, number, "" or why it is left out
        self._out = 0
        self._text: list[str] = []
        self._tags = self._number = 0
        self._path: tuple[int, ...] = ()

    def _why(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag in UNSEEN or tag in ASIDE:
            return "aside"
        words, inside = _words(attrs), any(t in ARTICLE for t, _, _ in self._open)
        if tag in ("html", "body") or tag in ARTICLE and not words & COMMENTS:
            return ""
        role = next((v or "" for k, v in attrs if k == "role"), "").lower()
        if words & COMMENTS:
            return "comments"
        if tag == "header" or words & WORDS == {"header"} and words & OWN_HEADER:
            return "" if inside or words & OWN_HEADER else "aside"
        return "aside" if role in ROLES or words & WORDS else ""

    def _line(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.lines.append((text, self._tags, self._path))
            self._text.clear()
        self._tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE and tag not in VOID:
            if attrs and (why := self._why(tag, attrs)):
                self._enter(tag, why)
            elif self._out and tag == self._open[-1][0]:
                self._enter(tag, "")
            else:
                self._tags += 1
            return
        if tag in VOID:
            if tag in INLINE:
                self._tags += 1
            else:
                self._text.append(" ") if tag == "br" else self._line()
                self._tags += tag == "br"
            return
        self._line()
        why = self._why(tag, attrs)
        if tag in ARTICLE and not why and not self.articles and self._out and not any(w == "comments" or t in UNSEEN for t, _, w in self._open if w):
            self._open.clear()  # what came before was left open
            self._out, self._path = 0, ()
        self._tags = 1
        if tag == "p":
            self._leave("p", stop=True)
        self._enter(tag, why)
        if tag in ARTICLE and not self._out:
            self.articles.append(self._number)

    def _enter(self, tag: str, why: str) -> None:
        self._number += 1
        self._open.append((tag, self._number, why))
        self._out += bool(why)
        self._path = (*self._path, self._number) if tag != "p" and tag not in INLINE else self._path

    def _leave(self, tag: str, stop: bool = False) -> None:
        """Closes the innermost open tag and what was left open in it; stop: only if no container lies between."""
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                for t, n, why in self._open[i:]:
                    self._out -= bool(why)
                del self._open[i:]
                self._path = tuple(n for t, n, _ in self._open if t != "p" and t not in INLINE)
                return
            if stop and self._open[i][0] not in INLINE:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in INLINE:
            if self._out and any(t == tag for t, _, _ in self._open):
                self._leave(tag)
            return
        self._line()
        self._leave(tag)

    def handle_data(self, data: str) -> None:
        if not self._out:
            self._text.append(data)

    def finished(self) -> Lines:
        self.close()
        self._line()
        return self


def smoothed(ratios: list[float], sigma: float = SIGMA) -> list[float]:
    """Each ratio as the Gaussian mean of its neighbours; beyond the ends there are none."""
    reach = math.ceil(3 * sigma)
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    got = []
    for i in range(len(ratios)):
        low, high = max(0, i - reach), min(len(ratios), i + reach + 1)
        near = weights[low - i + reach : high - i + reach]
        got.append(sum(w * r for w, r in zip(near, ratios[low:high], strict=True)) / sum(near))
    return got


def clusters(lines: list[tuple[str, int, tuple[int, ...]]]) -> list[int]:
    """The lines whose smoothed ratio reaches the standard deviation of all; at least the highest."""
    if not lines:
        return []
    curve = smoothed([len(text) / max(1, tags) for text, tags, _ in lines])
    mean = sum(curve) / len(curve)
    cut = min(math.sqrt(sum((x - mean) ** 2 for x in curve) / len(curve)), max(curve))
    return [i for i, x in enumerate(curve) if x >= cut]


def selected(found: Lines) -> str:
    lines, articles = found.lines, set(found.articles)
    if not lines:
        return ""
    content = clusters(lines)
    if not any(articles.intersection(lines[i][2]) for i in content) and any(articles.intersection(p) for _, _, p in lines):
        content = [i for i, (_, _, p) in enumerate(lines) if articles.intersection(p)]  # a short article beside longer text
    inside = [i for i in content if articles.intersection(lines[i][2])]
    if inside:
        weight: dict[int, int] = {}
        for i in inside:
            for number in articles.intersection(lines[i][2]):
                weight[number] = weight.get(number, 0) + len(lines[i][0])
        best = max(weight.values())
        holders = {n for n, w in weight.items() if w >= best / 2}
        return " ".join(text for text, _, path in lines if holders.intersection(path))
    weight, total = {}, 0
    for i in content:
        total += len(lines[i][0])
        for number in lines[i][2]:
            weight[number] = weight.get(number, 0) + len(lines[i][0])
    holder = max((n for n, w in weight.items() if w >= SHARE * total), default=0)  # inner containers have higher numbers
    return " ".join(text for text, _, path in lines if not holder or holder in path)


def main_text(html: str | None) -> str:
    parser = Lines()
    for at in range(0, len(html or ""), PIECE):
        parser.feed(html[at : at + PIECE])
    return selected(parser.finished())


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    common.ship_code(pages.sparkSession)
    kinds = pages.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.col("html").cast("string"))
    return rows.mapInArrow(run, f"page_id {kinds['page_id'].dataType.simpleString()}, url {kinds['url'].dataType.simpleString()}, text string, n_chars long")


def of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(common.table(spark, sf_dir, "pages"))
