"""Replies of a model that do not fit the schema: asked for once more, then every field abstains.

The steps are tables, so that a caller writes the replies between them and pays for none twice:
first = nested.completions(replies); again = unfit(first); second = nested.completions(replies to again); settled(...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.nested import FIELDS


def unfit(parsed: DataFrame, key: str) -> DataFrame:
    """The keys to ask for again."""
    return parsed.filter(~F.col("ok")).select(key)


def settled(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """One row for each row of first, which has one a key, as second has: the first reply if it fits, else the second,
    else one without figures that abstains from all fields. attempts tells how often the model was asked, error why a row
    abstains; a key that second lacks was asked once."""
    names = [c for c in first.columns if c not in (key, "ok")]
    again = second.select(key, F.struct("ok", *names).alias("_again"))
    rows = first.select(key, F.struct("ok", *names).alias("_first")).join(again, key, "left")
    one, two = F.col("_first.ok"), F.coalesce("_again.ok", F.lit(False))
    lost = ~one & ~two
    kept = {"abstained": F.lit(",".join(FIELDS)), "confidence": F.lit(0.0)}

    def column(name: str):
        if name in FIELDS:
            none = F.lit(None)
        else:
            none = kept.get(name, F.col(f"_first.{name}"))
        return F.when(one, F.col(f"_first.{name}")).when(two, F.col(f"_again.{name}")).otherwise(none).alias(name)

    attempts = F.when(~one & F.col("_again").isNotNull(), 2).otherwise(1)
    error = F.when(lost, F.lit("schema violation, abstained"))
    return rows.select(key, (~lost).alias("ok"), *map(column, names), attempts.alias("attempts"), error.alias("error"))
