"""Headings of reports: items and parts with offsets, and the regions that items open.

Lines are taken apart and headings told apart with built-in functions inside each row, so offsets count code points and
nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sections import item_order, section

#: An item heading has a sign or a title after its number; titles have at most 120 characters.
ITEM = r"(?i)^[ \t]*Item[ \t\u00a0]+([0-9]{1,2}[A-C]?)(?:[ \t]*[.:—–-]+[ \t]*(.{0,120})|[ \t]+(\S.{0,119}))$"
PART = r"(?i)^[ \t]*PART[ \t\u00a0]+([IVX]{1,4})\b"


def _lines(docs: DataFrame, key: str, text: str, pattern: str, extra: list[str]) -> DataFrame:
    """(key, pos, line) of the lines that match: a line's place is the length of what is before it. Only matching
    lines leave the row, each with its number; lengths are summed up to it from the array of line lengths."""
    cut = docs.select(key, *extra, F.split(text, "\n").alias("_l"))
    wanted = F.filter(F.transform("_l", lambda line, i: F.struct(i.alias("i"), line.alias("line"))), lambda x: x["line"].rlike(pattern))
    found = cut.select(key, *extra, F.transform("_l", lambda x: F.char_length(x) + 1).alias("_n"), F.explode(wanted).alias("_h"))
    pos = F.aggregate(F.slice("_n", F.lit(1), F.col("_h.i")), F.lit(0).cast("bigint"), lambda s, n: s + n)
    return found.select(key, *extra, pos.alias("pos"), F.col("_h.line").alias("line"))


def _title(line: Column) -> Column:
    both = F.concat(F.regexp_extract(line, ITEM, 2), F.regexp_extract(line, ITEM, 3))
    return F.regexp_replace(both, "^[ .:\\-—–]+|[ .:\\-—–]+$", "")


def item_headings(docs: DataFrame, key: str = "doc_id", text: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """(key, pos, item, title) of every item heading, page headers (an item with nothing after it) left out."""
    got = _lines(docs, key, text, ITEM, list(extra))
    return got.select(key, *extra, "pos", F.upper(F.regexp_extract("line", ITEM, 1)).alias("item"), _title(F.col("line")).alias("title"))


def part_headings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return _lines(docs, key, text, PART, []).select(key, "pos", F.upper(F.regexp_extract("line", PART, 1)).alias("part"))


def with_regions(docs: DataFrame, text: str = "text", form: str = "form", to: str = "regions") -> DataFrame:
    """Rows with an array of their regions (start, end, item, title, section): an item counts if it is greater than all
    before it in its part; its region ends where the next begins, or with the text. Null for a null text."""
    cut = docs.withColumn("_l", F.split(text, "\n"))
    heads = F.filter(F.transform("_l", lambda line, i: F.struct(i.alias("i"), line.alias("line"))), lambda x: x["line"].rlike(ITEM) | x["line"].rlike(PART))
    cut = cut.withColumns({"_n": F.transform("_l", lambda x: F.char_length(x) + 1), "_h": heads, "_len": F.char_length(text).cast("bigint")}).drop("_l")

    def told(x: Column) -> Column:
        item = F.upper(F.regexp_extract(x["line"], ITEM, 1))  # empty for a part
        return F.struct(x["i"].alias("i"), item.alias("item"), _title(x["line"]).alias("title"), item_order(item).alias("order"))

    def fold(a: Column, x: Column) -> Column:
        pos = F.aggregate(F.slice("_n", a["i"] + 1, x["i"] - a["i"]), a["pos"], lambda s, n: s + n)
        take = (x["item"] != "") & (a["best"].isNull() | (x["order"] > a["best"]))
        best = F.when(take, x["order"]).when(x["item"] != "", a["best"])
        kept = F.when(take, F.concat(a["kept"], F.array(F.struct(pos.alias("start"), x["item"].alias("item"), x["title"].alias("title"))))).otherwise(a["kept"])
        return F.struct(x["i"].alias("i"), pos.alias("pos"), best.alias("best"), kept.alias("kept"))

    none = "named_struct('i', 0, 'pos', 0L, 'best', cast(null as struct<number:int,letter:string>), 'kept', cast(array() as array<struct<start:bigint,item:string,title:string>>))"
    kept = cut.withColumn("_h", F.transform("_h", told)).withColumn("_h", F.aggregate("_h", F.expr(none), fold)["kept"])
    whole = F.transform("_h", lambda k, i: F.struct(
        k["start"].alias("start"), F.coalesce(F.get("_h", i + 1)["start"], F.col("_len")).alias("end"), k["item"].alias("item"), k["title"].alias("title"), section(k["item"], F.col(form)).alias("section")))
    return kept.withColumn(to, whole).drop("_n", "_h", "_len")


def item_regions(docs: DataFrame, key: str = "doc_id", text: str = "text", form: str = "form") -> DataFrame:
    """(key, start, end, item, title, section) of the regions of each text. A text without headings has no region."""
    return with_regions(docs.select(key, form, text), text, form, "_regions").select(key, F.inline("_regions"))
