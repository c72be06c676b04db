"""I-Match fingerprints: distinct terms within a band of inverse document frequency, hashed over randomised lexicons.

Document frequencies are counted over all different texts, so that copies do not push a text's own terms out of the
band. Terms in the band form the lexicon; its size is bounded by the mean number of distinct terms a text divided by
the band's floor; it is broadcast up to MOST_TERMS terms and joined by a shuffle beyond.
The lexicon is dealt at random into subsets of three sizes; a fingerprint has one hash a subset, of the sorted
distinct terms of the document that fall into it. An edit changes only the hashes of the subsets that it touches, so
the share of equal hashes tells how alike two texts are: small subsets answer for long texts, large ones for short.
A text without a term of the band has a fingerprint of empty subsets only, which says so: it is like equal texts alone.

Defined cases: a null text is empty; equal texts have equal fingerprints and the likeness 1, also if repeated; other texts
with equal fingerprints have the likeness 1 if a subset is filled, else 0; a null doc_id counts as the smallest; rows with equal
doc_id follow each other in an order of their own; a single document is its own next one; a text of any length is read
as a whole; no rows give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: The band: terms in at least 1/256 and at most a quarter of the different texts, and in two at least.
FLOOR, CEILING = 1 / 256, 1 / 4
#: Subsets: for each size, the lexicon is dealt into that many parts, of which the first sixteen are used.
PARTS, USED = (16, 64, 512), 16
#: Terms of a lexicon that is sent to all tasks; a larger one is joined by a shuffle.
MOST_TERMS = 1_000_000
#: Subsets of a size that must be filled before their share of equal hashes counts in full.
ENOUGH = 4
_NONE = -1  # the hash of no terms
#: Ids to a block, and rows from which a block is split.
_BLOCK, _HOT = 256, 4096


def term_hashes(text: Column) -> Column:
    """Distinct terms as ascending hashes: runs of letters and digits in lower case."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, floor: float = FLOOR, ceiling: float = CEILING) -> DataFrame:
    """The hashes of the band's terms, t, as a table."""
    own = docs.select(common.text_of().alias("text")).withColumn("k", F.xxhash64("text"))
    total = own.select("k").distinct().count()
    low, high = max(2, -(-total * floor // 1)), max(2, total * ceiling)
    terms = own.dropDuplicates(["k"]).select(F.explode(term_hashes(F.col("text"))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    found, _ = common.written(terms.filter(F.col("df").between(int(low), int(high))).select("t").repartition(8), "lexicon")  # bounded: few files
    return found


def _subsets(keys: Column, parts: int, shift: int) -> Column:
    """Sixteen bits of the hash of the sorted terms of each of the first sixteen of so many parts; a part is chosen by
    bits of the term."""

    def part(t: Column) -> Column:
        return F.pmod(F.shiftright(t, shift), F.lit(parts))

    def short(inside: Column) -> Column:
        return F.when(F.size(inside) == 0, F.lit(_NONE)).otherwise(F.xxhash64(inside).bitwiseAND(F.lit(0xFFFF)).cast("int"))

    def hashes(inside: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(USED - 1)), lambda s: short(F.filter(inside, lambda t: part(t) == s)))

    inside = keys if parts == USED else F.filter(keys, lambda t: part(t) < USED)
    return F.get(F.transform(F.array(inside), hashes), F.lit(0))


def signature(keys: Column) -> Column:
    """Sixteen bits a subset, -1 where the subset is empty, of sorted distinct terms."""
    return F.concat(*(_subsets(keys, parts, 14 + 12 * i) for i, parts in enumerate(PARTS)))


def told_by(rows: DataFrame, by: list[str], texts: list[str], lex: DataFrame) -> DataFrame:
    """Rows of unique columns `by` and text columns -> `by` and, under each text's name, the sorted terms that tell it.

    Terms are looked up one a row and gathered again; with a broadcast lexicon they stay in their partition, so rows
    dealt by a column of `by` are not dealt again."""
    hint = F.broadcast if lex.count() <= MOST_TERMS else lambda x: x
    hashes = [term_hashes(F.coalesce(F.col(c), F.lit(""))).alias(f"_{i}") for i, c in enumerate(texts)]
    split = rows.select(*by, *hashes)
    ends = [sum((F.size(f"_{j}") for j in range(i + 1)), F.lit(0)).alias(f"_e{i}") for i in range(len(texts))]
    one = split.select(*by, *ends, F.posexplode_outer(F.concat(*(F.col(f"_{i}") for i in range(len(texts))))).alias("_pos", "t"))
    one = one.join(hint(lex.withColumn("_in", F.lit(True))), "t", "left").withColumn("_in", F.coalesce("_in", F.lit(False)))
    starts = [F.lit(0), *(F.col(f"_e{i}") for i in range(len(texts) - 1))]
    inside = [(F.col("_pos") >= a) & (F.col("_pos") < F.col(f"_e{i}")) for i, a in enumerate(starts)]
    one = one.filter(F.col("_in") | F.coalesce(F.col("_pos"), F.lit(0)).eqNullSafe(0))  # the first stays, so that no row goes
    got = one.groupBy(*by).agg(*(F.collect_list(F.when(F.col("_in") & inside[i], F.col("t"))).alias(f"_h{i}") for i in range(len(texts))))
    terms = [F.sort_array(F.array_distinct(f"_h{i}")).alias(c) for i, c in enumerate(texts)]
    return got.select(*by, *terms)


def as_text(sig: Column) -> Column:
    """Four hexadecimal digits a subset, dashes where it is empty."""
    return F.array_join(F.transform(sig, lambda x: F.when(x == _NONE, "----").otherwise(F.lower(F.lpad(F.hex(x), 4, "0")))), "")


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets of one size that are not empty in both, the share of equal hashes; the largest of the sizes.
    Fewer than ENOUGH filled subsets count as so many; equal signatures are alike by 1 if a subset is filled, else by 0."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == _NONE) & (y == _NONE), 0).when(x == y, 3).otherwise(1))

    def share(z: Column) -> Column:
        return F.size(F.filter(z, lambda x: x == 3)) / F.greatest(F.size(F.filter(z, lambda x: x > 0)), F.lit(ENOUGH))

    shares = F.transform(F.array(both), lambda z: F.greatest(*(share(F.slice(z, 1 + USED * i, USED)) for i in range(len(PARTS)))))
    return F.when((a == b) & F.exists(a, lambda x: x != _NONE), 1.0).otherwise(F.get(shares, F.lit(0)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """text_key (the text's 64-bit hash) and fingerprint of every different text."""
    rows = docs.select(common.text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))
    keys = told_by(rows, ["text_key"], ["text"], lexicon(docs))
    return keys.select("text_key", as_text(signature(F.col("text"))).alias("fingerprint"))


def _next_blocks(blocks: DataFrame) -> DataFrame:
    """For each block the next lower one that has rows, for the lowest the highest. Blocks are dealt by range;
    only one row a range meets in a single task."""
    spark = blocks.sparkSession
    dealt, _ = common.written(blocks.distinct().repartitionByRange(common.cores(spark), "block").withColumn("range", F.spark_partition_id()), "blocks")
    lower = Window.partitionBy("range").orderBy(F.desc("block"))
    b = dealt.withColumn("lower", F.lead("block").over(lower))
    tops = dealt.groupBy("range").agg(F.max("block").alias("top"))
    down = Window.orderBy(F.desc("range"))
    tops = tops.select("range", F.coalesce(F.lead("top").over(down), F.first("top").over(down)).alias("below"))
    return b.join(tops, "range").select("block", F.coalesce("lower", "below").alias("next_block"))


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, k (nulls as the smallest), h, u, text and block. A block is a run of ids; one with many rows, which can
    only be if ids are repeated, is split by id and at random, so no id holds a task up."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("k"), common.text_of().alias("text"))
    base = base.withColumns({"h": F.xxhash64("text"), "u": F.lit(0).cast("bigint"), "b": F.floor(F.col("k") / _BLOCK)})
    hot = base.groupBy("b").agg(F.count("*").alias("n")).filter(F.col("n") > _HOT).select("b")
    if hot.isEmpty():
        return base.withColumn("block", F.col("b"))
    none = F.lit(0).cast("bigint")
    hot, _ = common.written(hot.withColumn("hot", F.lit(True)), "hot-blocks")
    base = base.withColumn("u", F.monotonically_increasing_id()).join(hot, "b", "left")
    return base.withColumn("block", F.struct("b", F.when(F.col("hot"), F.col("k")).otherwise(none).alias("k"), F.when(F.col("hot"), F.pmod(F.xxhash64("h", "u"), F.lit(4096))).otherwise(none).alias("s")))


def against_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints every text and its edited form, whose last third comes from the next document in descending ids."""
    lex = lexicon(docs)
    base = _placed(docs)
    heads = base.groupBy("block").agg(F.max_by("text", F.struct("k", "h", "u")).alias("head"))
    follow = _next_blocks(base.select("block"))
    heads = follow.join(heads.withColumnRenamed("block", "next_block"), "next_block").select("block", "head")
    w = Window.partitionBy("block").orderBy(F.desc("k"), F.desc("h"), F.desc("u"))
    rows = base.withColumns({"inside": F.lead("text").over(w), "row": F.row_number().over(w)}).join(heads, "block")
    rows = rows.withColumn("next", F.coalesce("inside", "head"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third)))
    by = ["block", "row", "doc_id", "n_chars", "edited_sha256", "same_edited", "same_next"]
    rows = rows.select("block", "row", "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), (F.col("edited") == F.col("text")).alias("same_edited"), (F.col("next") == F.col("text")).alias("same_next"), "text", "edited", F.when(F.col("inside").isNull(), F.col("head")).alias("head"))
    keys = told_by(rows, by, ["text", "edited", "head"], lex)
    last = Window.partitionBy("block").orderBy("row")
    keys = keys.select(*by, signature(F.col("text")).alias("sig"), signature(F.col("edited")).alias("esig"), signature(F.col("head")).alias("hsig"))
    keys = keys.withColumn("next_sig", F.coalesce(F.lead("sig").over(last), "hsig"))
    return keys.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("esig")).alias("edited_fingerprint"),
        F.when(F.col("same_edited"), 1.0).otherwise(likeness(F.col("sig"), F.col("esig"))).alias("near_edited"),
        F.when(F.col("same_next"), 1.0).otherwise(likeness(F.col("sig"), F.col("next_sig"))).alias("near_next"),
    )
