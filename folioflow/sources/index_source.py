"""spark.read.format("daily_index"): the daily indexes under a folder as one relation, a partition a day.

Options: path (the base folder), start and end (days, both included; yyyy-MM-dd), days (in a partition, 1 by default). A comparison of `filed` with a day
leaves out the days that it rules out before any file is opened; a form that is asked for is dropped while lines are
read. A day without an index has no rows."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from .landing import index_path
from .tables import ship_code

_SCHEMA = "cik string, company string, form string, filed date, path string, accession string"


@dataclass
class Days(InputPartition):
    days: list[datetime.date]


def parsed(line: str) -> tuple | None:
    """The row of a line; None unless it has five fields, digits for a number and a day of the calendar."""
    parts = [p.strip(" ") for p in line.split("|")]
    if len(parts) != 5 or not (parts[0].isascii() and parts[0].isdigit()) or len(parts[3]) != 8 or not (parts[3].isascii() and parts[3].isdigit()):
        return None
    try:
        filed = datetime.datetime.strptime(parts[3], "%Y%m%d").date()
    except ValueError:
        return None
    number = parts[0].lstrip("0") or "0"
    return number.rjust(10, "0")[:10], parts[1], parts[2], filed, parts[4], parts[4].rsplit("/", 1)[-1].removesuffix(".txt")


class DailyIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return "daily_index"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DailyIndexReader:
        return DailyIndexReader(self.options["path"], *(datetime.date.fromisoformat(self.options[o]) for o in ("start", "end")), int(self.options.get("days", "1")))


class DailyIndexReader(DataSourceReader):
    """A day's index lies in the day's own file, but a line may be filed on another day: only an index of the same day
    counts for a comparison of `filed`, so pushed days are checked again on each row."""

    def __init__(self, path: str, start: datetime.date, end: datetime.date, days: int = 1):
        self.path, self.start, self.end, self.days = path, start, end, days
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and column in ("filed", "form"):
                self.tests.append((column, type(f).__name__, f.value))
            else:
                yield f

    def _fits(self, column: str, value) -> bool:
        test = {
            "EqualTo": lambda a, b: a == b, "In": lambda a, b: a in b, "GreaterThan": lambda a, b: a > b, "GreaterThanOrEqual": lambda a, b: a >= b,
            "LessThan": lambda a, b: a < b, "LessThanOrEqual": lambda a, b: a <= b,
        }
        return all(test[kind](value, wanted) for c, kind, wanted in self.tests if c == column)

    def partitions(self) -> list[Days]:
        days = (self.start + datetime.timedelta(i) for i in range((self.end - self.start).days + 1))
        held = [d for d in days if self._fits("filed", d)]
        return [Days(held[i : i + self.days]) for i in range(0, len(held), self.days)]

    def read(self, partition: Days) -> Iterator[tuple]:
        for day in partition.days:
            yield from self._read(day)

    def _read(self, day: datetime.date) -> Iterator[tuple]:
        from pyarrow import fs

        at = index_path(self.path, day)
        store, at = (fs.LocalFileSystem(), "/" + at.removeprefix("file:").lstrip("/")) if at.startswith(("file:", "/")) else fs.FileSystem.from_uri(at)
        try:
            lines = store.open_input_stream(at)
        except FileNotFoundError:
            return
        rest = b""
        with lines:
            while piece := lines.read(1 << 20):
                *whole, rest = (rest + piece).split(b"\n")
                yield from self._rows(whole, day)
        yield from self._rows([rest], day)

    def _rows(self, lines: list[bytes], day: datetime.date) -> Iterator[tuple]:
        for line in lines:
            row = parsed(line.decode("utf-8", "replace").rstrip("\r"))
            if row and row[3] == day and self._fits("form", row[2]):
                yield row


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with filters handed to it."""
    ship_code(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DailyIndex)


def write_indexes(filings: DataFrame, path: str) -> None:
    """Writes filings (cik, company, form, filed, path) as daily indexes under a folder, a file a day."""
    ship_code(filings.sparkSession)
    lines = filings.filter("filed is not null").select("filed", F.concat_ws("|", "cik", "company", "form", F.date_format("filed", "yyyyMMdd"), "path").alias("line"))

    def write(day: pa.Table) -> pa.Table:
        from pyarrow import fs

        at = index_path(path, day["filed"][0].as_py())
        store, at = (fs.LocalFileSystem(), "/" + at.removeprefix("file:").lstrip("/")) if at.startswith(("file:", "/")) else fs.FileSystem.from_uri(at)
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        own = f"{at}.{uuid.uuid4().hex}"  # of this attempt alone
        with store.open_output_stream(own) as out:
            out.write(("CIK|Company Name|Form Type|Date Filed|Filename\n" + "-" * 80 + "\n").encode())
            out.write("\n".join(sorted(day["line"].to_pylist())).encode() + b"\n")
        store.move(own, at)
        return day.slice(0, 1).select(["filed"])

    lines.groupBy("filed").applyInArrow(write, "filed date").write.format("noop").mode("overwrite").save()
