"""Queries of the answer key over observations made of orders and lineitem, each with SQL written apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import resolver
from ..sources.tables import lines_of_orders, table

#: Field specs: (field, period, unit, tag, pref).
SPECS = [("revenue", "duration", "F", "R", 0), ("revenue", "duration", "F", "A", 1), ("revenue", "duration", "O", "N", 2), ("assets", "instant", "F", "N", 0), ("assets", "instant", "F", "A", 1), ("assets", "instant", "O", "N", 2)]


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Each line of an order as an observation: customer, return flag, status, price, a period that ends on the day of
    shipping; one in eight lines is an instant, one in nine has no date of filing."""
    rows = lines_of_orders(spark, folder)
    end = F.col("l_shipdate").cast("date")
    days = (F.lit(330) + F.pmod(F.col("l_partkey"), F.lit(100))).cast("int")
    return rows.select(
        (F.col("o_custkey") % 200).alias("cik"), F.col("l_returnflag").alias("tag"), F.col("l_linestatus").alias("unit"), F.col("l_extendedprice").cast("decimal(38,4)").alias("val"),
        F.when(F.col("l_suppkey") % 8 != 0, F.date_sub(end, days)).alias("start_d"), end.alias("end_d"),
        F.when(F.col("l_linenumber") % 3 == 0, "10-K").when(F.col("l_linenumber") % 3 == 1, "10-K/A").otherwise("10-Q").alias("form"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("o_orderdate").cast("date")).alias("filed"), F.col("l_orderkey").cast("string").alias("accn"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SPECS, "field string, period string, unit string, tag string, pref int")


def facts_annual_filter(spark, folder):
    o = observations(spark, folder)
    return o.filter(resolver.is_annual(F.col("start_d"), F.col("end_d"))).select("seq", F.datediff("end_d", "start_d").alias("days"))


def fiscal_year_of(spark, folder):
    return observations(spark, folder).select("seq", T.fiscal_year(F.col("end_d")).alias("fy"))


def fiscal_year_for(spark, folder):
    return observations(spark, folder).select("seq", resolver.filing_year(F.col("form"), F.col("filed")).alias("fy"))


def _shown(df: DataFrame) -> DataFrame:
    return df.select("cik", "fy", "field", "pref", F.col("val").cast("double").alias("val"), "tag", "unit", "accn", "form", F.date_format("filed", "yyyy-MM-dd").alias("filed"), "restated")


def resolve_field(spark, folder):
    return _shown(resolver.resolved(observations(spark, folder), specs(spark)))


def resolve_candidates(spark, folder):
    return _shown(resolver.resolved_candidates(observations(spark, folder), specs(spark)))


def _pins(o: DataFrame) -> DataFrame:
    return o.groupBy("cik", T.fiscal_year(F.col("end_d")).alias("fy")).agg(F.max("accn").alias("pin"))


def prefer_else_fallback(spark, folder):
    o = observations(spark, folder)
    return _shown(resolver.resolved(o, specs(spark), _pins(o)))


def restated_flag(spark, folder):
    got = resolver.resolved_candidates(observations(spark, folder), specs(spark))
    return got.groupBy("field", "tag").agg(F.count_if(F.col("restated")).alias("n_restated"), F.count("*").alias("n"))


def mode_fiscal_year(spark, folder):
    o = observations(spark, folder)
    wanted = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("accn"), F.lit(1900).alias("fallback"))
    return resolver.reported_year(o, wanted, "seq")


def tag_diagnosis(spark, folder):
    """For each resolved revenue the tags whose annual value is within half a percent of it: a join by the company and
    year, with the band in the condition, so no pair of other companies is met."""
    facts = resolver.resolved(observations(spark, folder), specs(spark)).filter("field = 'revenue'").select("cik", "fy", F.col("val").alias("asked"))
    rows = observations(spark, folder).filter(resolver.is_annual(F.col("start_d"), F.col("end_d"))).withColumn("fy", T.fiscal_year(F.col("end_d")))
    near = F.abs(F.col("asked") - F.col("val")) <= 0.005 * F.abs(F.col("asked"))
    return rows.join(facts, ["cik", "fy"]).filter(near).select("cik", "fy", "tag", "unit").distinct()


def score_alternatives(spark, folder):
    """Answers made from the tag liked least of a field, some in other units, a little off, or none."""
    o = observations(spark, folder)
    others = resolver.resolved_candidates(o, specs(spark))
    last = others.groupBy("cik", "fy", "field").agg(F.max_by("val", "pref").cast("double").alias("v"))
    k = (F.col("cik") + F.col("fy")) % 6
    answer = F.when(k == 0, F.col("v") / 1000).when(k == 1, F.col("v") * 1.001).when(k == 2, F.col("v") * 1.5).when(k == 3, F.col("v") * 37).when(k == 4, F.col("v"))
    asked = last.select("cik", "fy", "field", answer.alias("answer"), (F.col("cik") % 10 == 9).alias("abstained"))
    return resolver.scored(asked, resolver.resolved(o, specs(spark)), others).groupBy("field", "verdict").agg(F.count("*").alias("n"))


_O = """o AS (SELECT o_custkey % 200 AS cik, l_returnflag AS tag, l_linestatus AS unit, l_extendedprice AS val,
 CASE WHEN l_suppkey % 8 <> 0 THEN CAST(l_shipdate AS DATE) - CAST(330 + l_partkey % 100 AS INTEGER) END AS start_d, CAST(l_shipdate AS DATE) AS end_d,
 CASE l_linenumber % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-K/A' ELSE '10-Q' END AS form, CASE WHEN l_partkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS filed,
 CAST(l_orderkey AS VARCHAR) AS accn, l_orderkey * 10 + l_linenumber AS seq FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
y AS (SELECT *, CAST(CASE WHEN strftime(end_d, '%m%d') <= '0114' THEN year(end_d) - 1 ELSE year(end_d) END AS INTEGER) AS fy, CAST(end_d - start_d AS BIGINT) AS days FROM o)"""
_SPECS = ", ".join(f"('{f}', '{p}', '{u}', '{t}', {k})" for f, p, u, t, k in SPECS)
_C = f"""{_O}, m(field, period, unit, tag, pref) AS (VALUES {_SPECS}),
c AS (SELECT y.*, field, pref FROM y JOIN m USING (tag, unit) WHERE (period = 'duration' AND days >= 340 AND days <= 400) OR (period = 'instant' AND start_d IS NULL))"""


def _ranked(pool: str, by: str) -> str:
    return f"""{_C}, q AS ({pool}), v AS (SELECT *, count(DISTINCT val) OVER (PARTITION BY cik, fy, field, pref) > 1 AS restated,
 row_number() OVER (PARTITION BY {by} ORDER BY pref, filed NULLS LAST, accn, val, tag, unit, form, start_d NULLS FIRST) AS nth FROM q)
SELECT cik, fy, field, CAST(pref AS INTEGER) AS pref, val, tag, unit, accn, form, strftime(coalesce(filed, end_d), '%Y-%m-%d') AS filed, restated FROM v WHERE nth = 1"""


_TEN_K = "SELECT * FROM (SELECT *, bool_or(form = '10-K') OVER (PARTITION BY cik, fy, field, pref) AS k FROM {0}) WHERE NOT k OR form = '10-K'"
_PINNED = "(SELECT * FROM (SELECT c.*, accn = pin AS own, bool_or(accn = pin) OVER (PARTITION BY cik, fy, field, pref) AS has FROM c JOIN (SELECT cik, fy, max(accn) AS pin FROM y GROUP BY ALL) USING (cik, fy)) WHERE own OR NOT has)"
_ALL = _ranked(_TEN_K.format("c"), "cik, fy, field, pref")

_NEAR = "abs({0} - x) <= 0.005 * abs(x)"
_SCORED = f"""SELECT field, verdict, count(*) AS n FROM (SELECT field, CASE WHEN cik % 10 = 9 OR answer IS NULL THEN 'abstained' WHEN answer = truth THEN 'exact'
 WHEN abs(answer - truth) <= 0.005 * abs(truth) THEN 'within_tolerance' WHEN list_contains(others, answer) THEN 'exact'
 WHEN len(list_filter(others, lambda x: {_NEAR.format('answer')})) > 0 THEN 'within_tolerance'
 WHEN len(list_filter([truth], lambda x: {' OR '.join(_NEAR.format(f'answer {sign} {k}') for k in ('1e3', '1e6', '1e9') for sign in '*/')})) > 0 THEN 'scale_error'
 WHEN greatest(answer, truth) / least(answer, truth) > 10 THEN 'hallucinated' ELSE 'wrong' END AS verdict
 FROM (SELECT *, CASE (cik + fy) % 6 WHEN 0 THEN v / 1000 WHEN 1 THEN v * 1.001E0 WHEN 2 THEN v * 1.5E0 WHEN 3 THEN v * 37E0 WHEN 4 THEN v END AS answer
  FROM (SELECT cik, fy, field, arg_max(val, pref) AS v, arg_min(val, pref) AS truth, list(val) AS others FROM (WITH {_ALL}) GROUP BY ALL))) GROUP BY ALL"""

QUERIES = {
    "score_alternatives": (score_alternatives, _SCORED),
    "facts_annual_filter": (facts_annual_filter, f"WITH {_O} SELECT seq, CAST(days AS INTEGER) AS days FROM y WHERE days BETWEEN 340 AND 400"),
    "fiscal_year_of": (fiscal_year_of, f"WITH {_O} SELECT seq, fy FROM y"),
    "fiscal_year_for": (fiscal_year_for, f"WITH {_O} SELECT seq, CAST(CASE WHEN form = '10-Q' OR month(filed) >= 7 THEN year(filed) ELSE year(filed) - 1 END AS INTEGER) AS fy FROM o"),
    "resolve_field": (resolve_field, "WITH " + _ranked(_TEN_K.format("c"), "cik, fy, field")),
    "resolve_candidates": (resolve_candidates, "WITH " + _ALL),
    "prefer_else_fallback": (prefer_else_fallback, "WITH " + _ranked(_TEN_K.format(_PINNED), "cik, fy, field")),
    "restated_flag": (restated_flag, f"SELECT field, tag, count(*) FILTER (restated) AS n_restated, count(*) AS n FROM (WITH {_ALL}) GROUP BY ALL"),
    "mode_fiscal_year": (mode_fiscal_year, f"WITH {_O}, n AS (SELECT accn, fy, count(*) AS n, min(seq) AS s FROM y WHERE start_d IS NULL OR days BETWEEN 340 AND 400 GROUP BY ALL), r AS (SELECT accn, fy, row_number() OVER (PARTITION BY accn ORDER BY n DESC, s, fy) AS nth FROM n) SELECT CAST(o_orderkey AS VARCHAR) AS accn, CAST(coalesce(fy, 1900) AS INTEGER) AS fy FROM orders LEFT JOIN r ON accn = CAST(o_orderkey AS VARCHAR) AND nth = 1"),
    "join_band_tolerance": (tag_diagnosis, f"SELECT DISTINCT y.cik, y.fy, y.tag, y.unit FROM (WITH {_O} SELECT * FROM y) y JOIN (WITH {_ranked(_TEN_K.format('c'), 'cik, fy, field')}) f ON f.field = 'revenue' AND f.cik = y.cik AND f.fy = y.fy WHERE y.days BETWEEN 340 AND 400 AND y.val BETWEEN f.val - 0.005 * abs(f.val) AND f.val + 0.005 * abs(f.val)"),
}
