"""Upserts, incremental loads and cache look-ups over keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upserted(old: DataFrame, new: DataFrame, key: str, keep_if_null: list[str]) -> DataFrame:
    """Rows of new replace those of old; in keep_if_null a null of new keeps the old value."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    here = F.col(f"n.{key}").isNotNull()
    cols = [F.coalesce(f"n.{key}", f"o.{key}").alias(key)]
    for c in old.columns:
        if c != key:
            cols.append((F.coalesce(f"n.{c}", f"o.{c}") if c in keep_if_null else F.when(here, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))).alias(c))
    return j.select(*cols)


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row of each key; of equally new ones the largest by its other columns, so that every run takes the
    same. An aggregate, so rows of a key combine before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, order)]
    best = rows.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_b"))
    return best.select(*(F.col(c) if c in keys else F.col("_b")[c].alias(c) for c in rows.columns))


def pending(new: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows of new whose digest is not the stored one."""
    s = stored.select(key, F.col(digest).alias("_old"))
    return new.join(s, key, "left").filter(~F.col(digest).eqNullSafe(F.col("_old"))).drop("_old")


def landing_status(stored: DataFrame, incoming: DataFrame, overwrite: bool = False) -> DataFrame:
    """(prefix, status) of incoming file sets (prefix, filename, sha256): landed, unchanged, conflict or overwritten."""
    known = stored.select("prefix").distinct().withColumn("known", F.lit(True))
    s = stored.select("prefix", "filename", F.col("sha256").alias("old"))
    per = incoming.join(s, ["prefix", "filename"], "left").groupBy("prefix").agg(F.bool_and(F.col("sha256").eqNullSafe(F.col("old"))).alias("same"))
    other = "overwritten" if overwrite else "conflict"
    return per.join(known, "prefix", "left").select("prefix", F.when(F.col("known").isNull(), "landed").when(F.col("same"), "unchanged").otherwise(other).alias("status"))


def with_new_values(rows: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """One column replaced where new (key, column) has a value; all other rows and columns as they are."""
    n = new.select(key, F.col(column).alias("_new"))
    return rows.join(n, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def verified(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(prefix, filename, ok) for each entry (prefix, filename, sha256) of a manifest: the file's bytes (prefix,
    filename, content) hash to it. A missing file is not ok."""
    got = files.select("prefix", "filename", F.sha2("content", 256).alias("_now"))
    return manifest.join(got, ["prefix", "filename"], "left").select("prefix", "filename", F.coalesce(F.col("_now") == F.col("sha256"), F.lit(False)).alias("ok"))


def computed_once(rows: DataFrame, digest: str, compute) -> DataFrame:
    """Rows with what compute (a function of a DataFrame, keeping digest) adds, run once for each digest: equal contents
    are worked on once and every row gets the result. Rows without a digest are kept, with nulls."""
    once = rows.filter(F.col(digest).isNotNull()).dropDuplicates([digest])
    made = compute(once)
    added = [c for c in made.columns if c not in rows.columns]
    return rows.join(made.select(digest, *added), digest, "left")
