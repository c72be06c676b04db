"""The answer key: which reported observation stands for a field of a fiscal year.

Observations are rows of (cik, tag, unit, val, start_d, end_d, form, filed, accn); specs are rows of (field, period,
unit, tag, pref), pref counting the tags of a field from the one liked most. Everything is a grouped aggregate whose
parts combine before the shuffle, so neither a company with many filings nor a common tag gathers in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fiscal_year, verdict

#: Days of an annual period, the form that is preferred.
ANNUAL = (340, 400)
PREFERRED = "10-K"


def is_annual(start: Column, end: Column, days: tuple[int, int] = ANNUAL) -> Column:
    return F.coalesce(F.datediff(end, start).between(*days), F.lit(False))


def filing_year(form: Column, filed: Column) -> Column:
    """The fiscal year guessed from the date of filing: annual reports of the first half are about the year before."""
    return F.year(filed) - F.when(form.startswith("10-K") & (F.month(filed) < 7), 1).otherwise(0)


def candidates(observations: DataFrame, specs: DataFrame, days: tuple[int, int] = ANNUAL) -> DataFrame:
    """Observations that may stand for a field, with field, pref and fy: durations of a year, instants without a start.
    Spark sends the specs to all tasks if they are small."""
    fits = ((F.col("period") == "duration") & is_annual(F.col("start_d"), F.col("end_d"), days)) | ((F.col("period") == "instant") & F.col("start_d").isNull())
    return observations.join(specs, ["tag", "unit"]).filter(fits & F.col("end_d").isNotNull()).withColumn("fy", fiscal_year(F.col("end_d")))


def _pools(rows: DataFrame, keys: list[str], pinned: Column) -> DataFrame:
    """For each group the earliest observation of its pool, and whether the pool has different values. The pool: pinned
    rows if there are any, and of these the preferred form if it occurs."""
    order = F.struct(F.coalesce("filed", F.lit("9999-12-31").cast("date")).alias("at"), F.coalesce("accn", F.lit("")).alias("by"), "val", "tag", "unit", "form", "accn", "start_d", "end_d", "filed")
    preferred = F.coalesce(F.col("form") == PREFERRED, F.lit(False))
    aggregates = []
    for name, within in (("_all", F.lit(True)), ("_form", preferred), ("_pin", pinned), ("_both", pinned & preferred)):
        first = F.min(F.when(within, order))
        restated = F.min(F.when(within, F.col("val"))) != F.max(F.when(within, F.col("val")))
        aggregates.append(F.when(first.isNotNull(), F.struct(first.alias("o"), restated.alias("restated"))).alias(name))
    got = rows.groupBy(*keys).agg(*aggregates)
    return got.select(*keys, F.coalesce("_both", "_pin", "_form", "_all").alias("p")).select(*keys, "p.o.val", "p.o.tag", "p.o.unit", "p.o.form", "p.o.accn", "p.o.start_d", "p.o.end_d", F.coalesce("p.o.filed", "p.o.end_d").alias("filed"), "p.restated")


def resolved_candidates(observations: DataFrame, specs: DataFrame, days: tuple[int, int] = ANNUAL) -> DataFrame:
    """One fact for each tag of a field that a company reports for a year: (cik, fy, field, pref, val, ...)."""
    return _pools(candidates(observations, specs, days), ["cik", "fy", "field", "pref"], F.lit(False))


def resolved(observations: DataFrame, specs: DataFrame, pins: DataFrame | None = None, days: tuple[int, int] = ANNUAL) -> DataFrame:
    """One fact for each company, year and field: of the tag liked most that was reported. pins (cik, fy, pin) asks for
    the figures of a filing where it has them."""
    rows = candidates(observations, specs, days)
    if pins is None:
        return _best(_pools(rows, ["cik", "fy", "field", "pref"], F.lit(False)))
    rows = rows.join(pins.select("cik", "fy", "pin"), ["cik", "fy"], "left")
    return _best(_pools(rows, ["cik", "fy", "field", "pref"], F.coalesce(F.col("accn") == F.col("pin"), F.lit(False))))


def _best(facts: DataFrame) -> DataFrame:
    rest = [c for c in facts.columns if c not in ("cik", "fy", "field")]
    return facts.groupBy("cik", "fy", "field").agg(F.min_by(F.struct(*rest), "pref").alias("b")).select("cik", "fy", "field", "b.*")


def reported_year(observations: DataFrame, wanted: DataFrame, place: str, days: tuple[int, int] = ANNUAL) -> DataFrame:
    """(accn, fy) for wanted filings (accn, fallback): the fiscal year of most of their annual and instant observations,
    of equally common ones that seen first by the column `place`, then the earliest."""
    fit = observations.filter(F.col("end_d").isNotNull() & (F.col("start_d").isNull() | is_annual(F.col("start_d"), F.col("end_d"), days)))
    years = fit.groupBy("accn", fiscal_year(F.col("end_d")).alias("fy")).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    most = years.groupBy("accn").agg(F.max_by("fy", F.struct("n", -F.col("first"), -F.col("fy"))).alias("fy"))
    return wanted.join(most, "accn", "left").select("accn", F.coalesce("fy", "fallback").alias("fy"))


def scored(answers: DataFrame, facts: DataFrame, alternatives: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Answers (cik, fy, field, answer, abstained) with truth and verdict: the fact is the truth, and the figures of the
    field's other tags, a few for each, would do as well. An answer without a fact is unresolvable."""
    key = ["cik", "fy", "field"]
    others = alternatives.groupBy(*key).agg(F.collect_list(F.col("val").cast("double")).alias("_others"))
    rows = answers.join(facts.select(*key, F.col("val").cast("double").alias("truth")), key, "left").join(others, key, "left")
    found = verdict(F.col("answer"), F.col("truth"), F.col("abstained"), tolerance, F.coalesce("_others", F.array().cast("array<double>")))
    return rows.select(*answers.columns, "truth", found.alias("verdict"))
