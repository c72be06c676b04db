"""Scalar functions over text, identifiers and numbers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: words a token, by which token counts are estimated.
WORDS_A_TOKEN = 0.75


def padded_id(c: Column) -> Column:
    """A registry number as ten digits: an optional CIK prefix and leading zeros go first; nothing left counts as 0."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), "^CIK", ""), "^0+", "")
    return F.lpad(F.coalesce(F.nullif(bare, F.lit("")), F.lit("0")), 10, "0")


def token_count(text: Column) -> Column:
    """Estimated tokens of white-space separated words; 0 without any."""
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return F.when(words > 0, F.floor(words / F.lit(WORDS_A_TOKEN)) + 1).otherwise(0).cast("int")


def normalised_space(text: Column) -> Column:
    """Line ends as \\n, runs of blanks as one, at most one empty line, nothing at the ends."""
    out = text
    for pattern, to in ((" ", " "), (" ", "\n"), (" ", "\n\n"), ("\r\n?", "\n"), ("[ \\t]+", " "), (" *\n *", "\n"), ("\n{3,}", "\n\n"), ("^\\s+|\\s+$", "")):
        out = F.regexp_replace(out, pattern, to)
    return out


def content_hash(model: Column, dim: Column, text: Column) -> Column:
    """SHA-256 of model, dimension and text, separated by zero bytes."""
    return F.sha2(F.concat(model, F.lit("\x00"), dim.cast("string"), F.lit("\x00"), text), 256)


def fiscal_year(end: Column) -> Column:
    """Year of a period's end; the first two weeks of January belong to the year before."""
    return F.year(end) - F.when((F.month(end) == 1) & (F.dayofmonth(end) <= 14), 1).otherwise(0)


def iso_day(c: Column | str) -> Column:
    """The day that a text in the form yyyy-MM-dd names, null for any other text. Texts of four digits, two and two are cast,
    which costs a small part of what a parser of patterns does; that one reads the rest."""
    text = F.col(c) if isinstance(c, str) else c
    return F.when(text.rlike(r"\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date")).otherwise(F.try_to_date(text, "yyyy-MM-dd"))


def relative_error(value: Column, truth: Column) -> Column:
    """|value - truth| / |truth|; 0 for 0/0, null for x/0."""
    v, t = value.cast("double"), truth.cast("double")
    return F.when((v == 0) & (t == 0), F.lit(0.0)).when(t != 0, F.abs(v - t) / F.abs(t))


def magnitude_ratio(value: Column, truth: Column) -> Column:
    """The larger magnitude over the smaller; 1 for 0 and 0, null if one of them is 0."""
    a, b = F.abs(value.cast("double")), F.abs(truth.cast("double"))
    return F.when((a == 0) & (b == 0), F.lit(1.0)).when((a != 0) & (b != 0), F.greatest(a, b) / F.least(a, b))


def scale_factor(value: Column, truth: Column, tolerance: float = 0.005) -> Column:
    """The power of a thousand by which value has to be multiplied (negative: divided) to fit truth; null if none."""
    v, out = value.cast("double"), F.lit(None).cast("bigint")
    for k in (10**9, 10**6, 10**3):
        for scaled, sign in ((v / k, -1), (v * k, 1)):
            out = F.when((v != 0) & (truth != 0) & (relative_error(scaled, truth) <= tolerance), F.lit(k * sign)).otherwise(out)
    return out


def safe_decimal(raw: Column) -> Column:
    """A number of a text, null where there is none."""
    return raw.try_cast("decimal(38,4)")


def verdict(value: Column, truth: Column, abstained: Column, tolerance: float = 0.005, others: Column | None = None, unreadable: Column | None = None) -> Column:
    """One of unresolvable, abstained, exact, within_tolerance, scale_error, hallucinated, wrong; the first that fits.

    others: an array of figures that would also do, tried before a wrong scale. unreadable: an answer that is no number."""
    error = relative_error(value, truth)
    near = F.lit(False) if others is None else F.exists(others, lambda o: F.coalesce(relative_error(value, o) <= tolerance, F.lit(False)))
    same = F.lit(False) if others is None else F.exists(others, lambda o: F.coalesce(value == o, F.lit(False)))
    bad = F.lit(False) if unreadable is None else unreadable
    ratio = magnitude_ratio(value, truth)
    return (
        F.when(truth.isNull(), "unresolvable")
        .when(abstained | (value.isNull() & ~bad), "abstained")
        .when(bad, "hallucinated")
        .when(value == truth, "exact")
        .when(error <= tolerance, "within_tolerance")
        .when(same, "exact")
        .when(near, "within_tolerance")
        .when(scale_factor(value, truth, tolerance).isNotNull(), "scale_error")
        .when(ratio.isNull() | (ratio > 10), "hallucinated")
        .otherwise("wrong")
    )


def figure_forms(value: Column) -> Column:
    """The ways a whole figure is printed: with and without commas, in ones, thousands and millions where these are whole."""
    v = F.abs(value.cast("decimal(38,4)"))
    one = lambda k: F.when((v != 0) & (v % k == 0), F.array(F.format_number(v / k, 0), (v / k).cast("decimal(38,0)").cast("string"))).otherwise(F.array().cast("array<string>"))
    return F.concat(one(1), one(1000), one(1000000))


def decoded(raw: Column) -> Column:
    """Bytes as text: UTF-8 where valid, else Windows-1252, and Latin-1 if a byte has no meaning in that. The signs that
    Windows puts in place of the control characters of Latin-1 are told by the codec itself."""
    signs = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    known = {k: v for k, v in signs.items() if v}
    latin = F.decode(raw, "ISO-8859-1")
    windows = F.translate(latin, "".join(known), "".join(known.values()))
    odd = latin.rlike("[" + "".join(f"\\x{ord(k):02x}" for k, v in signs.items() if not v) + "]")
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).when(odd, latin).otherwise(windows)


def is_index_text(text: Column) -> Column:
    """Whether a table is a list of contents: its first 400 characters say so, or name the statements while hardly any
    of its characters are digits."""
    head = F.lower(F.substring(text, 1, 400))
    digits = F.char_length(F.regexp_replace(text, r"\P{Nd}", ""))
    return (head.contains("index to") & head.contains("page")) | (head.contains("consolidated financial statements") & (digits < 0.02 * F.char_length(text)))


def path_segment(raw: Column) -> Column:
    """A part of a path: slashes as hyphens, of the rest letters, digits and -_. only; nothing left counts as unknown."""
    return F.coalesce(F.nullif(F.regexp_replace(F.translate(F.trim(raw), "/\\", "--"), r"[^\p{L}\p{N}\-_.]", ""), F.lit("")), F.lit("unknown"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two vectors, accumulated in double."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def filing_url(base: str, cik: Column, accession: Column) -> Column:
    """Where a filing lies: its number without leading zeros, its accession without hyphens."""
    bare = F.coalesce(F.nullif(F.regexp_replace(cik, "^0+", ""), F.lit("")), F.lit("0"))
    return F.concat(F.lit(base.rstrip("/") + "/"), bare, F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"))


def backoff_seconds(attempt: Column, retry_after: Column, base: float = 1.0, cap: float = 30.0, most: float = 300.0) -> Column:
    """The longest wait before the next attempt: what the server asks for, up to a bound, if that is a number; else a
    doubling one. Full jitter draws from 0 to it, once, by the caller."""
    asked = retry_after.try_cast("double")
    return F.when(asked >= 0, F.least(asked, F.lit(most))).otherwise(F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(cap)))


def model_cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """Cost of a call by prices of a million tokens."""
    return (tokens_in * F.lit(price_in) + tokens_out * F.lit(price_out)) / F.lit(1e6)
