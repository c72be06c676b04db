"""Settings that are checked when they are made, and run ids that follow a run's jobs and rows."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    contact: str
    window: int = 512
    overlap: int = 64
    least: int = 32
    context_chunks: int = 14
    context_tokens: int | None = 6000

    def __post_init__(self):
        if not re.fullmatch(r".*[^@\s]+@[^@\s]+\.[^@\s]+.*", self.contact):
            raise ValueError("the contact must hold an e-mail address")
        if self.overlap >= self.window:
            raise ValueError("the overlap must be smaller than the window")


def begin_run(spark: SparkSession, name: str) -> str:
    """A new run id; jobs of this thread are grouped under it."""
    run = uuid.uuid4().hex[:12]
    spark.sparkContext.setJobGroup(run, name)
    return run


def tagged(rows: DataFrame, run: str) -> DataFrame:
    return rows.withColumn("run_id", F.lit(run))
