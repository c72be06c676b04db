"""A keyed store as catalog tables: declared layout, versions that share untouched partitions, swapped in by one view.

A version is a partitioned catalog table. A write puts new files for the partitions it touches into a folder of its own,
declares the next version with those folders and the folders of all other partitions, and then replaces the view under
the store's name. Readers plan against one version and keep it; until the view is replaced, everybody reads the old one,
so a write that fails leaves nothing but files that no table names. Only Spark's catalog is used.

Writers take turns; which version is the last is asked from the catalog. Partition values are few by design and pass
through the driver; rows never do."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import scratch


class RepeatedKey(ValueError):
    """Rows of a write have no key, or one that another row has."""


class BrokenRule(ValueError):
    """Rows of a write break a declared rule."""


def declare(spark: SparkSession, name: str, schema: StructType, partition: list[str] = (), bucket: list[str] = (), buckets: int = 0, sort: list[str] = (), location: str | None = None) -> bool:
    """Creates a catalog table with this layout unless it is there; true if it was made. Another layout under the name is refused.

    Two tables bucketed alike by their join keys join without a shuffle. With a location, dropping the table leaves its files."""
    if spark.catalog.tableExists(name):
        columns = {c.name: c for c in spark.catalog.listColumns(name)}
        here = ([f.name for f in schema], [c for c in columns if columns[c].isPartition], [c for c in columns if columns[c].isBucket])
        if sorted(here[0]) != sorted(columns) or here[1] != list(partition) or sorted(here[2]) != sorted(bucket):
            raise ValueError(f"{name} exists with another layout: {here}")
        return False
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
    parted = f" PARTITIONED BY ({', '.join(partition)})" if partition else ""
    clustered = f" CLUSTERED BY ({', '.join(bucket)}){f' SORTED BY ({', '.join(sort)})' if sort else ''} INTO {buckets} BUCKETS" if bucket else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parted}{clustered}{f" LOCATION {_literal(location)}" if location else ""}")
    return True


def checked_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """rows as they are; raises RepeatedKey if a key is null or occurs twice."""
    none = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    bad = rows.groupBy(*key).count().filter((F.col("count") > 1) | none).limit(3).collect()
    if bad:
        raise RepeatedKey(f"keys {[tuple(r[:-1]) for r in bad]}")
    return rows


def load(rows: DataFrame, name: str, key: list[str], buckets: int = 0) -> None:
    """Appends rows to a declared table; a key that is repeated among them or that the table has is refused."""
    spark = rows.sparkSession
    stored = spark.table(name)
    checked_key(rows, key)
    if stored.join(rows.select(*key), key, "left_semi").limit(1).count():
        raise RepeatedKey(f"{name} has some of the keys")
    own = rows.select(*stored.columns)
    bucketed = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    own = own.repartition(buckets, *bucketed) if bucketed and buckets else own  # a file a bucket
    own.write.insertInto(name)


@dataclass(frozen=True)
class Store:
    """name: of the view; key: its column; partition: a column by which rows are laid; rules: what every row must hold."""

    spark: SparkSession
    name: str
    key: str
    partition: str
    schema: StructType
    keep_if_null: tuple[str, ...] = ()
    rules: tuple[Column, ...] = ()

    def create(self) -> Store:
        """Declares the store; without effect if it is there."""
        if not self.spark.catalog.tableExists(self.name):
            self._swap(0, {})
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def version(self) -> int:
        found = (re.fullmatch(rf"{self.name}_v(\d+)", t.name) for t in self.spark.catalog.listTables())
        names = {int(m[1]) for m in found if m}
        text = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'View Text'").first().data_type
        now = int(re.search(rf"{self.name}_v(\d+)", text)[1])
        assert now in names
        return now

    def locations(self) -> dict[str | None, str]:
        """Folder of each partition of the current version, by the value as text."""
        return self._places(self.version())

    def _places(self, version: int) -> dict[str | None, str]:
        table, found = f"{self.name}_v{version}", {}
        for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect():
            value = _unescaped(row[0].split("=", 1)[1])
            told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({self.partition} = {_literal(value)})").collect()
            found[value] = next(r.data_type for r in told if r.col_name == "Location")  # the partition's, before the table's
        return found

    def _swap(self, version: int, locations: dict[str | None, str]) -> None:
        table = f"{self.name}_v{version}"
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # of a write that failed after declaring it
        declare(self.spark, table, self.schema, [self.partition], location=scratch(self.spark, table))  # shares folders, so it must not own them
        parts = [f"PARTITION ({self.partition} = {_literal(v)}) LOCATION {_literal(at)}" for v, at in locations.items()]
        for i in range(0, len(parts), 500):
            self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(parts[i : i + 500])}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {table}")

    def _values(self, rows: DataFrame) -> list:
        return [r[0] for r in rows.select(self.partition).distinct().collect()]

    def _rewrite(self, touched: list, change: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Writes the touched partitions anew as change makes them from their rows, and swaps the version; the partitions written."""
        if not touched:
            return []
        touched = list(dict.fromkeys(touched))
        own = [v for v in touched if v is not None]
        here = F.col(self.partition).isin(own) | F.col(self.partition).isNull() if None in touched else F.col(self.partition).isin(own)
        rows = change(self.read().filter(here)).select(*self.schema.names)
        for rule in self.rules:
            rows = rows.withColumn(self.key, F.when(F.coalesce(rule, F.lit(False)), F.col(self.key)).otherwise(F.raise_error(F.lit(f"a row of {self.name} breaks a rule"))))
        path = scratch(self.spark, self.name)
        try:
            rows.write.partitionBy(self.partition).parquet(path)
        except Exception as e:
            if f"a row of {self.name} breaks a rule" in str(e):
                raise BrokenRule(f"a row of {self.name} breaks a rule") from None
            raise
        made = self.spark.read.schema(self.schema).parquet(path)
        new = {_text(v): f"{path}/{self.partition}={_escaped(self.spark, v)}" for v in self._values(made)} if made.limit(1).count() else {}
        kept = {v: at for v, at in self.locations().items() if v not in {_text(t) for t in touched}}
        self._swap(self.version() + 1, kept | new)
        return sorted(map(str, {_text(t) for t in touched}))

    def upsert(self, new: DataFrame) -> list[str]:
        """Rows of new replace those with their key, wherever these lie, or are added; in keep_if_null a null keeps what is stored."""
        checked_key(new, [self.key])
        place = F.col(self.partition)
        held = self.read().select(self.key, place.alias("_was")).join(new.select(self.key), self.key, "left_semi")
        touched = self._values(new) + [r[0] for r in held.select("_was").distinct().collect()]

        def change(old: DataFrame) -> DataFrame:
            o, n = old.alias("o"), new.alias("n")
            both = o.join(n, F.col(f"o.{self.key}") == F.col(f"n.{self.key}"), "full_outer")
            here = F.col(f"n.{self.key}").isNotNull()
            cols = [F.when(here & F.col(f"n.{c}").isNotNull() if c in self.keep_if_null else here, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in self.schema.names]
            return both.select(*cols)

        return self._rewrite(touched, change)

    def update(self, new: DataFrame, columns: list[str]) -> list[str]:
        """Sets columns of the stored rows whose key new has; null leaves what is stored, unknown keys do nothing."""
        checked_key(new, [self.key])
        touched = self._values(self.read().select(self.key, self.partition).join(new.select(self.key), self.key, "left_semi"))
        fresh = new.select(self.key, *(F.col(c).alias(f"_{c}") for c in columns))
        return self._rewrite(touched, lambda old: old.join(fresh, self.key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}))

    def prune(self, kept: DataFrame, within: str) -> list[str]:
        """Of the groups (within) that kept names, deletes the rows whose key is not in kept; other groups stay. No rows in kept do nothing."""
        groups = kept.select(within).distinct()
        gone = self.read().join(groups, within, "left_semi").join(kept.select(self.key), self.key, "left_anti")
        return self.delete(gone)

    def delete(self, gone: DataFrame) -> list[str]:
        """Deletes the rows whose key gone has."""
        keys = gone.select(self.key)
        touched = self._values(self.read().select(self.key, self.partition).join(keys, self.key, "left_semi"))
        return self._rewrite(touched, lambda old: old.join(keys, self.key, "left_anti"))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drops all but the last keep versions and the folders that no version left names; those folders."""
        now, spark = self.version(), self.spark
        versions = sorted(int(m[1]) for t in spark.catalog.listTables() if (m := re.fullmatch(rf"{self.name}_v(\d+)", t.name)))
        old = [v for v in versions if v <= now - keep]
        named = {v: set(self._places(v).values()) for v in versions}
        gone = sorted(set().union(*(named[v] for v in old)) - set().union(*(named[v] for v in versions if v not in old))) if old else []
        for v in old:
            spark.sql(f"DROP TABLE {self.name}_v{v}")
        files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for at in gone:
            p = files(at)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return gone


_NULL = "__HIVE_DEFAULT_PARTITION__"


def _text(value) -> str | None:
    return None if value is None else str(value)


def _literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unescaped(name: str) -> str | None:
    return None if name == _NULL else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def _escaped(spark: SparkSession, value) -> str:
    """The value as it stands in the name of a folder."""
    return _NULL if value is None else spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
