"""Gated publishing: a stream whose batches are shown only if their measure passes.

A published batch is a catalog table over a folder of its own; the view under the published name is replaced in one
step. A batch that fails changes nothing but the log. A batch that runs again decides the same, replaces its own line of
the log, and never takes the place of a later batch."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scratch

_LOG = "name string, measured double, passed boolean, batch bigint"


@dataclass(frozen=True)
class Gate:
    """measure: one number of a batch (null does not pass); shown: the table that is published of it."""

    spark: SparkSession
    name: str
    floor: float
    measure: Callable[[DataFrame], DataFrame]
    shown: Callable[[DataFrame], DataFrame]
    root: str

    @classmethod
    def at(cls, spark: SparkSession, name: str, floor: float, measure, shown) -> Gate:
        return cls(spark, name, floor, measure, shown, scratch(spark, f"gate-{name}"))

    def published(self) -> int | None:
        """The batch that the view shows; None before any has passed."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        text = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'View Text'").first().data_type
        return int(re.search(rf"{self.name}_b(\d+)", text)[1])

    def log(self) -> DataFrame:
        """(batch, measured, passed) of every batch, each once."""
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log").select("batch", "measured", "passed")

    def __call__(self, batch: DataFrame, number: int) -> None:
        """The body of foreachBatch."""
        held = batch.persist()
        try:
            measured = self.measure(held).first()[0]
            passed = measured is not None and measured >= self.floor
            line = self.spark.createDataFrame([(self.name, None if measured is None else float(measured), passed, number)], _LOG)
            line.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.root}/log")
            last = self.published()
            if passed and (last is None or number >= last):
                self._publish(self.shown(held), number)
        finally:
            held.unpersist()

    def _publish(self, rows: DataFrame, number: int) -> None:
        path, table = scratch(self.spark, f"{self.name}-{number}"), f"{self.name}_b{number}"
        rows.write.parquet(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: its files stay for readers that began with it
        self.spark.catalog.createTable(table, path=path, source="parquet", schema=rows.schema)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {table}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Takes all that is new through the gate and stops."""
        stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def share_without(kind: str) -> Callable[[DataFrame], DataFrame]:
    """The share of events of a batch that are not of a kind."""
    return lambda rows: rows.agg(F.avg((F.col("event_type") != kind).cast("double")))
