"""Facts nested by taxonomy, tag and unit: written as gzipped JSON lines, read back through VARIANT.

No schema names the tags, so a tag that nobody knows yet is a row like any other. A company's facts may be several
bodies, so that no body grows without bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import iso_day

#: Facts of a body, more or less: a company with more has several bodies.
FACTS = 1_000


def write_bodies(observations: DataFrame, path: str, tasks: int | None = None, each: int = FACTS) -> None:
    """Observations (cik, taxonomy, tag, unit, val, start, end, form, filed, accn as text) as one JSON body a line.

    Facts are dealt by body once, in so many tasks (Spark's own number without it), and lie in the order of their nesting
    there, so that none of the groupings moves or sorts them again. Only companies of more than `each` facts are looked up."""
    fact = F.struct("val", "start", "end", "form", "filed", "accn")
    large = observations.groupBy(F.col("cik").alias("_cik")).agg(F.ceil(F.count("*") / each).alias("_n")).filter("_n > 1")
    share = F.when(F.col("_n").isNotNull(), F.pmod(F.xxhash64("accn", "tag", "end"), F.col("_n")))
    dealt = observations.join(F.broadcast(large), F.col("cik").eqNullSafe(F.col("_cik")), "left").withColumn("_b", F.xxhash64("cik", share)).drop("_cik", "_n")
    keys = ["_b", "cik", "taxonomy", "tag", "unit"]
    dealt = (dealt.repartition(tasks, "_b") if tasks else dealt.repartition("_b")).sortWithinPartitions(*keys)
    units = dealt.groupBy(*keys).agg(F.collect_list(fact).alias("facts"))
    tags = units.groupBy(*keys[:4]).agg(F.struct(F.map_from_entries(F.collect_list(F.struct("unit", "facts"))).alias("units")).alias("t"))
    taxonomies = tags.groupBy(*keys[:3]).agg(F.map_from_entries(F.collect_list(F.struct("tag", "t"))).alias("tags"))
    whole = taxonomies.groupBy(*keys[:2]).agg(F.map_from_entries(F.collect_list(F.struct("taxonomy", "tags"))).alias("facts"))
    whole.select("cik", "facts").write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").json(path)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """(cik, taxonomy, tag, unit, val, start_d, end_d, form, filed, accn) of all facts; bodies that are no JSON have none,
    dates and figures that cannot be read are null.

    A body's number is read before its facts, so that no fact carries the body along. Figures are read as text, since
    VARIANT builds their cast anew for each; it is left for what is no figure as text, such as truth values."""
    bodies = spark.read.text(path).select(F.try_parse_json("value").alias("body"))
    bodies = bodies.select(F.try_variant_get("body", "$.cik", "string").alias("cik"), F.try_variant_get("body", "$.facts", "variant").alias("facts"))
    rows = spark.sql(
        """SELECT cik, x.key AS taxonomy, t.key AS tag, u.key AS unit,
        coalesce(try_cast(try_variant_get(f.value, '$.val', 'string') AS decimal(38,4)), try_variant_get(f.value, '$.val', 'decimal(38,4)')) AS val,
        try_variant_get(f.value, '$.start', 'string') AS start, try_variant_get(f.value, '$.end', 'string') AS `end`,
        try_variant_get(f.value, '$.form', 'string') AS form, try_variant_get(f.value, '$.filed', 'string') AS filed,
        try_variant_get(f.value, '$.accn', 'string') AS accn
        FROM {bodies}, LATERAL variant_explode(facts) AS x,
        LATERAL variant_explode(x.value) AS t, LATERAL variant_explode(try_variant_get(t.value, '$.units', 'variant')) AS u,
        LATERAL variant_explode(u.value) AS f""",
        bodies=bodies,
    )
    return rows.select("cik", "taxonomy", "tag", "unit", "val", iso_day("start").alias("start_d"), iso_day("end").alias("end_d"), "form", iso_day("filed").alias("filed"), "accn")
