"""Ranked retrieval over tables of texts and vectors."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.stemming import english, stems
from ..sources.tables import scratch, ship_code

#: Rows, and queries, in one task of a dense search; queries in one matrix product.
ROW_BLOCK, QUERY_ROWS, SLICE = 20_000, 2_000, 64


def metadata_filter(equal: dict | None = None, any_of: dict | None = None, at_least: dict | None = None, at_most: dict | None = None) -> Column:
    """A conjunction of plain comparisons, which Parquet scans take over; without any, true."""
    parts = [F.col(c) == v for c, v in (equal or {}).items()]
    parts += [F.col(c).isin(list(v)) for c, v in (any_of or {}).items()]
    parts += [F.col(c) >= v for c, v in (at_least or {}).items()]
    parts += [F.col(c) <= v for c, v in (at_most or {}).items()]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_tokens(rows: DataFrame, text: str = "text", to: str = "tokens", stemmed: bool = False) -> DataFrame:
    """Lower-case runs of letters and digits, in order; stemmed: as English stems, stop words as empty strings that keep
    their places. An index keeps this column, so that searches read it."""
    return rows.withColumn(to, stems(words(F.col(text))) if stemmed else words(F.col(text)))


def matches(tokens: Column, all_of: list[str] = (), any_of: list[str] = (), none_of: list[str] = (), phrase: list[str] = ()) -> Column:
    """A web-search condition over a token array: all words, any of some, none of others, adjacent words. In a phrase an
    empty word stands for any one token."""
    out = F.lit(True)
    for w in all_of:
        out = out & F.array_contains(tokens, w)
    if any_of:
        out = out & F.arrays_overlap(tokens, F.array(*(F.lit(w) for w in any_of)))
    for w in none_of:
        out = out & ~F.array_contains(tokens, w)
    if "" in phrase:
        places = [i for i, w in enumerate(phrase) if w]
        first, rest = (places[0], places[1:]) if places else (0, [])
        at = F.filter(F.transform(tokens, lambda w, i: F.when(w == phrase[first], i)), lambda i: i.isNotNull())
        fits = reduce(lambda x, y: x & y, (F.array_contains(tokens, phrase[first]) for _ in places[:1]), F.lit(bool(places)))
        if rest:
            fits = fits & F.exists(at, lambda i: reduce(lambda x, y: x & y, (F.get(tokens, i + (k - first)).eqNullSafe(phrase[k]) for k in rest)))
        out = out & fits
    elif phrase:
        shifted = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
        out = out & shifted.contains(" " + " ".join(phrase) + " ")
    return out


def search_terms(query: str) -> list[tuple[bool, bool, list[str], bool]]:
    """(forbidden, quoted, words, or with the one before) for each term of a search line."""
    terms, either = [], False
    for sign, quoted, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', query):
        if word == "OR" and not sign:
            either = bool(terms)
            continue
        words = [w for w in re.split(r"[^\w]+|_+", (quoted or word).lower()) if w]
        if words:
            terms.append((bool(sign), bool(quoted), words, either))
            either = False
    return terms


def plain_words(query: str, stemmed: bool = False) -> list[str]:
    """The words of a search line that are not forbidden, each once; stemmed: their stems, without stop words."""
    words = [w for forbidden, _, words, _ in search_terms(query) if not forbidden for w in words]
    return [w for w in dict.fromkeys(map(english, words) if stemmed else words) if w]


def web_condition(tokens: Column, query: str, stemmed: bool = False) -> Column:
    """The condition of a search line: words must all occur, quoted ones side by side, a leading hyphen forbids, OR
    between two terms asks for either. Any other sign separates words; a line without words fits nothing. stemmed: for
    stemmed tokens; stop words ask for nothing, and inside quotes for any word."""
    parts: list[Column] = []
    for forbidden, quoted, words, either in search_terms(query):
        words = list(map(english, words)) if stemmed else words
        if not any(words):
            continue
        one = matches(tokens, phrase=words) if quoted else matches(tokens, all_of=[w for w in words if w])
        one = ~one if forbidden else one
        parts = [*parts[:-1], parts[-1] | one] if either and parts else [*parts, one]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(False)


def covers(places: Column, terms: Column | int) -> Column:
    """Cover density of the places (term: a number from 0, at) of so many terms, in their order: each shortest run of
    tokens that holds all terms adds a tenth, divided by one and the number of other tokens in it. 0 where a term is missing.

    A fold: a cover ends where the earliest of the terms' last places moves on."""
    places = F.transform(places, lambda x, k: F.struct(x["term"].alias("term"), x["at"].alias("at"), k.alias("nth")))
    none = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("nth"))
    start = F.struct(F.array_repeat(none, terms).alias("last"), none.alias("from"), F.lit(0.0).alias("score"))

    def step(state, x):
        last = F.transform(state["last"], lambda old, t: F.when(t == x["term"], F.struct(x["at"].alias("at"), x["nth"].alias("nth"))).otherwise(old))
        first = F.array_min(last)
        others = (x["at"] - first["at"]) - (x["nth"] - first["nth"])
        new = first["at"] > state["from"]["at"]
        return F.struct(last.alias("last"), F.when(new, first).otherwise(state["from"]).alias("from"), (state["score"] + F.when(new, 0.1 / (1 + others)).otherwise(0.0)).alias("score"))

    return F.aggregate(places, start, step, lambda s: s["score"])


def cover_density(tokens: Column, terms: list[str]) -> Column:
    """Cover density of a token array for distinct terms."""
    wanted = F.array(*(F.lit(t) for t in terms))
    places = F.filter(F.transform(tokens, lambda w, i: F.struct((F.array_position(wanted, w) - 1).cast("int").alias("term"), i.alias("at"))), lambda x: x["term"] >= 0)
    return covers(places, len(terms))


def bm25(rows: DataFrame, key: str, terms: list[str], k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best rows (key, score) by Okapi BM25; ties by key.

    One pass over the texts: it counts rows, lengths and rows with each term while it writes the counts of the rows that
    have a term. Only those are read again."""
    spark = rows.sparkSession
    wanted = list(dict.fromkeys(terms))
    counted = F.transform(F.array(words(F.col("text"))), lambda t: F.struct(F.size(t).alias("dl"), F.filter(t, lambda w: w.isin(*wanted)).alias("hits")))

    def times(term: str) -> Column:
        return F.size(F.filter("hits", lambda w: w == F.lit(term)))

    own = rows.select(key, F.inline(counted)).select(key, "dl", *(times(t).alias(f"tf{i}") for i, t in enumerate(wanted)))
    seen = Observation()
    here = [F.col(f"tf{i}") > 0 for i in range(len(wanted))]
    path = scratch(spark, "bm25")
    found = own.observe(seen, F.count("*").alias("n"), F.sum("dl").alias("tokens"), *(F.count_if(x).alias(f"df{i}") for i, x in enumerate(here)))
    found.filter(reduce(lambda x, y: x | y, here)).write.parquet(path)
    stats = seen.get
    n, mean = stats["n"], (stats["tokens"] or 0) / max(1, stats["n"])
    score = F.lit(0.0)
    for i in range(len(wanted)):
        tf, weight = F.col(f"tf{i}"), float(np.log(1 + (n - stats[f"df{i}"] + 0.5) / (stats[f"df{i}"] + 0.5)))
        score = score + weight * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / (mean or 1.0)))
    counts = spark.read.schema(own.schema).parquet(path)
    return counts.select(key, score.alias("score")).orderBy(F.desc(F.round("score", 9)), key).limit(k)


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.full_like(vectors, np.nan), where=length > 0)


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow column without null vectors, as doubles; a null component is not a number."""
    width = len(column[0]) if len(column) else 0
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def nearest(ids, vectors, names, queries, k: int, cells=None, wanted=None) -> pa.Table:
    """(query_id, vec_id, score): the k rows nearest to each query by cosine, ties by id, from Arrow columns; of the wanted
    cells only, if they are given. Vectors without a length are near to nothing. A few queries at a time are one matrix
    product, so memory is bounded by the rows."""
    found: list[list[np.ndarray]] = [[], [], []]
    if len(ids) and len(names):
        ids, names = ids.to_numpy(), names.to_numpy()
        rows, asked = _unit(_matrix(vectors)), _unit(_matrix(queries))
        if cells is not None:
            cells = cells.to_numpy()
            table = np.zeros((len(names), int(cells.max()) + 1), bool)
            for i, own in enumerate(wanted.to_pylist()):
                table[i, [c for c in own if c < table.shape[1]]] = True
        for a in range(0, len(names), SLICE):
            score = np.round(asked[a : a + SLICE] @ rows.T, 6)
            score[np.isnan(score)] = -np.inf
            if cells is not None:
                score[~table[a : a + SLICE, cells]] = -np.inf
            least = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k] if k < len(ids) else np.full(len(score), -np.inf)
            for name, own, last in zip(names[a : a + SLICE], score, least, strict=True):
                at = np.flatnonzero((own >= last) & (own > -np.inf))  # all that tie with the last of them
                at = at[np.lexsort((ids[at], -own[at]))][:k]
                for out, got in zip(found, (np.full(len(at), name), ids[at], own[at]), strict=True):
                    out.append(got)
    joined = [np.concatenate(x) if x else np.zeros(0) for x in found]
    return pa.table({"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)), "score": pa.array(joined[2].astype(np.float64))})


def dense_topk(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, rank): the k nearest rows of each query by cosine, exact; ties by id. Null vectors and
    those without a length are near to nothing.

    Blocks of ROW_BLOCK rows meet blocks of QUERY_ROWS queries, each pair in one task, which leaves its own k best of each
    query. The pairs of blocks are as many as the exact answer asks for, quadratic if both tables grow; a task is not."""
    ship_code(rows.sparkSession)
    some = queries.filter("query is not null").select(F.col("query_id").cast("bigint").alias("query_id"), "query")
    held = rows.filter("embedding is not null").select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    n, m = (max(1, -(-x.count() // size)) for x, size in ((held, ROW_BLOCK), (some, QUERY_ROWS)))

    def dealt(table: DataFrame, key: str, own: str, blocks: int, other: str, others: int) -> DataFrame:
        placed = table.withColumn(own, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left, right = dealt(held, "vec_id", "rb", n, "qb", m), dealt(some, "query_id", "qb", m, "rb", n)

    def best(rows: pa.Table, asked: pa.Table) -> pa.Table:
        return nearest(rows["vec_id"], rows["embedding"], asked["query_id"], asked["query"], k)

    both = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(best, "query_id bigint, vec_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rrf(runs: list[DataFrame], key: str, k: int = 60, top: int | None = None) -> DataFrame:
    """Reciprocal rank fusion of ranked runs (key, rank): score, number of runs that found the row, order by score then key."""
    bag = reduce(DataFrame.unionByName, [r.select(key, "rank", F.lit(i).alias("run")) for i, r in enumerate(runs)])
    out = bag.groupBy(key).agg(F.round(F.sum(1 / (k + F.col("rank"))), 9).alias("score"), F.count("*").alias("n_runs")).orderBy(F.desc("score"), key)
    return out.limit(top) if top else out
