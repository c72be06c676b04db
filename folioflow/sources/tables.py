"""Input tables and scratch space."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: under spark.checkpoint.dir, or with a local master a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="folioflow-")
    return f"{root.rstrip('/')}/folioflow/{name}-{uuid.uuid4().hex}"


def tasks_for(rows: DataFrame, each: int) -> int:
    """Tasks of some `each` rows for work that sorts or holds what it reads, at least as many as Spark takes for a shuffle.
    Spark's own number does not follow the input; counting a Parquet table reads no column."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // each))


#: Rows of the lines of orders that one task sorts or groups, more or less.
LINES = 500_000


def lines_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the columns of their orders, in tasks whose number follows the number of lines: the join sorts both sides
    in a task, and what is grouped after it is sorted there too."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    n = tasks_for(lines, LINES)
    return lines.repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors once an application, so that workers of any cluster import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="folioflow-code-")) / "folioflow_core.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            if "llm" not in p.relative_to(root).parts:
                z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)
