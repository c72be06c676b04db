"""What the operators of this package share: shared storage, worker code, and text defaults."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()
_local_shared: dict[str, str] = {}
#: Spark's setting by which the shuffle files of an execution are deleted at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class Shielded:
    """A table whose columns are renamed by their places, so that an operator's own columns clash with none of them.

    inner has them as c0, c1, ...; restore() gives the old names back and drops all else."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.inner = df.toDF(*(f"c{i}" for i in range(len(self.names))))

    def __call__(self, name: str) -> str:
        return f"c{self.names.index(name)}"

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(self.names)))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fixed fifth of the ids that no model may learn from; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors once an application, so that workers import it on any cluster."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # the default is too many long texts
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="folioflow-code-")) / "folioflow_code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def lean(run):
    """A worker function that gives memory back when its task ends: workers live on and serve other stages."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # not on this C library
                pass

    return wrapped


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Only a local master may do without."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and sc._jsc.sc().getCheckpointDir().isDefined():
        found = sc._jsc.sc().getCheckpointDir().get()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_shared.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="folioflow-shared-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/folioflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """Writes df to the shared folder, which cuts its lineage, and gives the table read back and its path.

    The shuffle files of this write go when it ends: nothing reads them again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes tables of written() that no later plan reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def store(uri: str):
    """(file system, path) of a folder in the shared storage, for workers that write or read ranges of files."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class SharedFile:
    """A file written under a name of this attempt's own: a lost or repeated task leaves no half-written file behind a name in use."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.name = f"{stem}-{uuid.uuid4().hex}{suffix}"
        self._fs, root = store(folder)
        self._fs.create_dir(root, recursive=True)
        self._path = f"{root}/{self.name}"
        self._out = self._fs.open_output_stream(self._path + ".part", compression=None)
        self._buffer = io.BytesIO()
        self.size = 0

    def write(self, data: bytes) -> int:
        at = self.size
        self._buffer.write(data)
        self.size += len(data)
        if self._buffer.tell() > 1 << 20:
            self._flush()
        return at

    def _flush(self) -> None:
        self._out.write(self._buffer.getvalue())
        self._buffer = io.BytesIO()

    def close(self) -> None:
        self._flush()
        self._out.close()
        self._fs.move(self._path + ".part", self._path)


def cores(spark: SparkSession) -> int:
    """At least this many tasks keep the cluster busy."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
