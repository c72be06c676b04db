"""Document structure: flattening HTML, cutting texts into overlapping windows, admitting context under a budget."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORDS_A_TOKEN
from . import html_tables

#: Tags whose content is no text.
_SILENT = {"script", "style", "link", "meta", "ix:header", "ix:references", "ix:resources", "ix:hidden", "xbrli:context", "xbrli:unit"}
#: Where texts may be cut, coarse places first.
_CUTS = (re.compile(r"\n{2,}"), re.compile(r"\n"), re.compile(r"(?<=[.!?])\s+(?=[A-Z(\"'])"))
#: Which code points are white space; all from the last on are not.
_BLANK = np.array([chr(i).isspace() for i in range(0x3002)])


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT and tag not in ("link", "meta"):
            self.quiet += 1

    def handle_endtag(self, tag):
        if tag in _SILENT and self.quiet:
            self.quiet -= 1

    def handle_data(self, data):
        if not self.quiet and data.strip():
            self.out.append(" ".join(data.split()))


def flat_text(html: str | None) -> str:
    p = _Text()
    p.feed(html or "")
    p.close()
    return "\n".join(p.out)


class _Blocks(_Text):
    """Prose and outermost tables in order. What a table has inside is kept as written until it ends; a table that only
    places text goes into the prose."""

    def __init__(self):
        super().__init__()
        self.done: list[tuple[str, str]] = []
        self.raw: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if not self.quiet and (tag == "table" or self.depth):
            self.depth += tag == "table"
            self.raw.append(self.get_starttag_text() or "")

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        if self.depth and not self.quiet:
            self.raw.append(f"</{tag}>")
            self.depth -= tag == "table"
            if not self.depth:
                self._table()

    def handle_data(self, data):
        if not self.depth:
            super().handle_data(data)
        elif not self.quiet:
            self.raw.append(escape(data))

    def _table(self):
        raw, self.raw, self.depth = "".join(self.raw), [], 0
        rows = html_tables.tables_of(raw)[0]
        if html_tables.is_layout(rows):
            self.out += filter(None, flat_text(raw).split("\n"))
        elif body := html_tables.markdown(html_tables.grid(rows)):
            self.flush()
            self.done.append(("table", body))

    def flush(self):
        if self.out:
            self.done.append(("prose", "\n".join(self.out)))
        self.out = []

    def close(self):
        super().close()
        if self.depth:
            self._table()
        self.flush()


def blocks_of(html: str | None) -> tuple[str, list[dict]]:
    """The text of a page and its blocks (kind, start, end) in it: prose and data tables as Markdown, an empty line
    between them."""
    p = _Blocks()
    p.feed(html or "")
    p.close()
    at, blocks = 0, []
    for kind, body in p.done:
        blocks.append({"kind": kind, "start": at, "end": at + len(body)})
        at += len(body) + 2
    return "\n\n".join(body for _, body in p.done), blocks


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, text and blocks of each page; a null page has an empty text and no blocks."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            got = [blocks_of(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([x for _, x in got], kind)], ["page_id", "text", "blocks"])

    return pages.select("page_id", "html").mapInArrow(run, "page_id bigint, text string, blocks array<struct<kind:string,start:int,end:int>>")


def estimated_tokens(text: str) -> int:
    words = len(text.split())
    return int(words / WORDS_A_TOKEN) + 1 if words else 0


class _Words:
    """Where the words of a text begin, so that the words of any span are counted by two look-ups."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = np.concatenate([[True], _BLANK[np.minimum(codes, len(_BLANK) - 1)], [True]])
        turns = np.flatnonzero(blank[1:] != blank[:-1])
        self.begin, self.end = turns[::2], turns[1::2]

    def tokens(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Estimated tokens of the spans a .. b; a word that a span cuts into counts in it."""
        first = np.searchsorted(self.end, a, "right")
        n = np.maximum(np.searchsorted(self.begin, b) - first, 0)
        return np.where(n > 0, (n / WORDS_A_TOKEN).astype(np.int64) + 1, 0)


def _hard_cuts(text: str, a: int, b: int, reach: int) -> list[int]:
    """Cuts of a span without better places: after the last blank of the second half of each stretch, or at its end."""
    cuts = [a]
    while b - cuts[-1] > reach:
        blank = text.rfind(" ", cuts[-1] + reach // 2, cuts[-1] + reach)
        cuts.append(cuts[-1] + reach if blank < 0 else blank + 1)
    return cuts[1:]


def _units(text: str, words: _Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, tokens) of the pieces that windows are made of. All places of a level are found at once; a level's
    places count inside the spans that the levels before left longer than `size` tokens."""
    edges = np.array([0, len(text)], np.int64)
    for places in (*((m.end() for m in cut.finditer(text)) for cut in _CUTS), None):
        long = words.tokens(edges[:-1], edges[1:]) > size
        if not long.any():
            break
        if places is None:
            reach = max(200, int(size * WORDS_A_TOKEN * 6))
            new = np.array([c for a, b in zip(edges[:-1][long], edges[1:][long], strict=True) for c in _hard_cuts(text, int(a), int(b), reach)], np.int64)
        else:
            new = np.fromiter(places, np.int64)
            of = np.searchsorted(edges, new, "right") - 1
            new = new[(of < len(long)) & long[np.minimum(of, len(long) - 1)]]
        edges = np.union1d(edges, new)
    tokens = words.tokens(edges[:-1], edges[1:])
    some = tokens > 0
    return edges[:-1][some], edges[1:][some], tokens[some]


def windows(text: str, size: int = 512, overlap: int = 64, least: int = 32) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of windows of whole pieces with at most `size` tokens, or of one longer piece; each window
    goes back over pieces of at least `overlap` tokens, but always moves on. White space at their ends does not count,
    and windows of fewer than `least` tokens are left out. Ends are found on the running sums of the pieces' tokens."""
    if overlap >= size:
        raise ValueError("the overlap must be smaller than the window")
    words = _Words(text)
    start, end, tokens = _units(text, words, size)
    upto = np.concatenate([[0], np.cumsum(tokens)])
    firsts, lasts, i = [], [], 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + size, "right")) - 1)
        firsts.append(start[i])
        lasts.append(end[j - 1])
        i = len(start) if j == len(start) else max(i + 1, int(np.searchsorted(upto, upto[j] - overlap, "right")) - 1)
    a, b = np.array(firsts, np.int64), np.array(lasts, np.int64)
    n = words.tokens(a, b)
    kept = n >= max(1, least)
    a, b, n = a[kept], b[kept], n[kept]
    a = np.maximum(a, words.begin[np.searchsorted(words.end, a, "right")])
    b = np.minimum(b, words.end[np.searchsorted(words.begin, b) - 1])
    return list(zip(a.tolist(), b.tolist(), n.tolist(), strict=True))


def flattened(pages: DataFrame) -> DataFrame:
    """page_id and the text of each page, in Arrow batches."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([flat_text(x) for x in b.column(1).to_pylist()], pa.string())], ["page_id", "text"])

    return pages.select("page_id", "html").mapInArrow(run, "page_id bigint, text string")


def chunked(docs: DataFrame, size: int = 512, overlap: int = 64, least: int = 32) -> DataFrame:
    """One row a window: doc_id, ordinal, char_start, char_end, token_count; text[char_start:char_end] is its text."""

    def run(batches):
        for b in batches:
            rows = [(d, k, *w) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for k, w in enumerate(windows(t or "", size, overlap, least))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64()] + [pa.int32()] * 4, strict=True)], ["doc_id", "ordinal", "char_start", "char_end", "token_count"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ordinal int, char_start int, char_end int, token_count int")


def admitted(hits: DataFrame, group: str, budget: int, cap: int | None = None) -> DataFrame:
    """(group, n, tokens, ids): which hits (group, step, rank, id, tokens, at, anchor) a context holds, in the order of
    their places `at`, joined by commas.

    Hits are taken by step and rank, each id once. At most `budget` are taken; the hits of an anchor step may all be taken
    if the budget was not reached when the step began. One that would exceed `cap` tokens in all is passed over. A fold
    over each group's sorted hits, of which there are as many as a question's searches give."""
    return admitted_to(hits, group, F.array(F.lit(budget)), cap).drop("budget")


def admitted_to(hits: DataFrame, group: str, budgets: Column, cap: int | None = None) -> DataFrame:
    """What `admitted` gives, for each budget of an array, with a column budget: the hits are read and gathered once."""
    one = F.struct(*(F.col(c) for c in ("step", "rank", "id", "tokens", "at", "anchor")))
    rows = hits.groupBy(group).agg(F.sort_array(F.collect_list(one)).alias("h")).withColumn("budget", F.explode(budgets))
    budget = F.col("budget")
    zero = F.struct(F.array().cast("array<struct<at:bigint,id:string>>").alias("ids"), F.lit(0).cast("bigint").alias("sum"), F.lit(None).cast("bigint").alias("step"), F.lit(0).alias("open"))

    def step(acc, x):
        begun = F.when(acc["step"].eqNullSafe(x["step"].cast("bigint")), acc["open"]).otherwise(F.size(acc["ids"]))
        room = F.when(x["anchor"], begun < budget).otherwise(F.size(acc["ids"]) < budget)
        new = ~F.exists(acc["ids"], lambda i: i["id"] == x["id"].cast("string"))
        fits = F.lit(True) if cap is None else acc["sum"] + x["tokens"] <= cap
        take = room & new & fits
        ids = F.when(take, F.concat(acc["ids"], F.array(F.struct(x["at"].cast("bigint").alias("at"), x["id"].cast("string").alias("id"))))).otherwise(acc["ids"])
        total = (acc["sum"] + F.when(take, x["tokens"]).otherwise(0)).cast("bigint")
        return F.struct(ids.alias("ids"), total.alias("sum"), x["step"].cast("bigint").alias("step"), begun.alias("open"))

    done = rows.select(group, "budget", F.aggregate("h", zero, step).alias("a"))
    return done.select(group, "budget", F.size("a.ids").alias("n"), F.col("a.sum").alias("tokens"), F.array_join(F.transform(F.sort_array("a.ids"), lambda x: x["id"]), ",").alias("ids"))


def rendered(chunks: DataFrame, group: str, order: str, heads: list[str], text: str = "text") -> DataFrame:
    """(group, context): the chunks of a group in order, each a line of heads in brackets and its text, rules between."""
    head = F.concat_ws(" ", *(F.concat(F.lit("["), F.col(h).cast("string"), F.lit("]")) for h in heads))
    body = F.concat_ws("\n", head, F.coalesce(F.col(text), F.lit("")))
    rows = chunks.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), body.alias("b")))).alias("c"))
    return rows.select(group, F.array_join(F.transform("c", lambda x: x["b"]), "\n\n---\n\n").alias("context"))


def is_kept(kind, tokens, text, least: int = 32):
    """Whether a chunk stays: tables do if they are not blank, prose from `least` tokens on."""
    return (F.trim(F.regexp_replace(text, r"\s+", " ")) != "") & ((kind == "table") | (tokens >= least))
