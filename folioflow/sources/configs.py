"""Configuration texts as small tables: the tags that may stand for a field, read on the driver.

A text is JSON or, where the yaml package can be imported, YAML. These files are written by hand and bounded by that;
Spark sends their tables to all tasks by their size."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.resolver import ANNUAL

try:
    import yaml
except ImportError:  # then configurations are JSON
    yaml = None

_SPEC = "field string, period string, unit string, tag string, pref int"


def parsed(text: str) -> dict:
    """The mapping that a text holds; an empty text holds none."""
    got = (yaml.safe_load(text) if yaml else json.loads(text)) if text.strip() else {}
    if not isinstance(got, dict):
        raise ValueError("a configuration is a mapping")
    return got


def tag_specs(spark: SparkSession, text: str) -> DataFrame:
    """(field, period, unit, tag, pref) for the resolver: pref counts the tags of a field from the one liked most. A
    field without units is in USD; a tag listed twice keeps its first place; an unknown period is an error."""
    rows = []
    for field, spec in (parsed(text).get("fields") or {}).items():
        if spec["period"] not in ("duration", "instant"):
            raise ValueError(f"{field}: the period is duration or instant")
        for pref, tag in enumerate(dict.fromkeys(spec["tags"])):
            rows += [(field, spec["period"], unit, tag, pref) for unit in spec.get("units", ["USD"])]
    return spark.createDataFrame(rows, _SPEC)


_MAPS = "fields map<string, struct<period: string, units: array<string>, tags: array<string>>>"


def tag_maps(rows: DataFrame, key: str, body: str = "body") -> DataFrame:
    """(key, field, period, unit, tag, pref) for the JSON configurations of many rows, by the rules of tag_specs, in one
    plan. A body that is null or holds no fields gives no row; a field without tags neither."""
    spec = rows.select(key, F.explode(F.from_json(body, _MAPS)["fields"]).alias("field", "spec"))
    known = F.col("spec.period").isin("duration", "instant")
    period = F.when(known, F.col("spec.period")).otherwise(F.raise_error(F.concat("field", F.lit(": the period is duration or instant"))).cast("string"))
    units = F.coalesce("spec.units", F.array(F.lit("USD")))
    tags = spec.select(key, "field", period.alias("period"), units.alias("units"), F.posexplode(F.array_distinct("spec.tags")).alias("pref", "tag"))
    return tags.select(key, "field", "period", F.explode("units").alias("unit"), "tag", "pref")


def annual_days(text: str) -> tuple[int, int]:
    """The fewest and most days of an annual period."""
    window = parsed(text).get("annual_duration_days") or {}
    return int(window.get("min", ANNUAL[0])), int(window.get("max", ANNUAL[1]))
