"""Small results as Markdown, JSON and metric lines."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shown(name: str, kind: str) -> Column:
    c = F.format_number(F.col(name), 4) if kind in ("double", "float") else F.col(name).cast("string")
    return F.coalesce(F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")), F.lit(""))


def markdown_table(report: DataFrame, order: list[str], most: int = 1000) -> DataFrame:
    """One row, one column markdown: a report as a table, sorted by columns. A report of more than `most` rows ends with a
    line that says how many more there are."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(_shown(n, k) for n, k in report.dtypes)), F.lit(" |"))
    head = f"| {' | '.join(report.columns)} |\n| {' | '.join('---' for _ in report.columns)} |"
    top = report.orderBy(*order).limit(most).select(F.struct(*order).alias("o"), cells.alias("line"))
    more = max(0, report.count() - most)
    lines = F.concat(F.array(F.lit(head)), F.transform("l", lambda x: x["line"]), F.array(*([F.lit(f"and {more} more")] if more else [])).cast("array<string>"))
    return top.agg(F.sort_array(F.collect_list(F.struct("o", "line"))).alias("l")).select(F.array_join(lines, "\n").alias("markdown"))


def merged_section(document: str, marker: str, body: str) -> str:
    """A document with the section between a marker's two comments replaced, or added at its end."""
    begin, end = f"<!-- {marker} -->", f"<!-- /{marker} -->"
    section = f"{begin}\n{body.strip()}\n{end}"
    head, found, rest = document.partition(begin)
    if not found:
        return f"{document.rstrip()}\n\n{section}\n" if document.strip() else section + "\n"
    return head + section + rest.partition(end)[2]


def write_report(report: DataFrame, order: list[str], path: str, marker: str) -> str:
    """Puts a report into a Markdown file on the driver, other sections kept; gives the new text."""
    file = Path(path)
    text = merged_section(file.read_text() if file.exists() else "", marker, markdown_table(report, order).first()[0])
    file.write_text(text)
    return text


def exposition(metrics: DataFrame) -> DataFrame:
    """Lines of metrics (name, label, value) as scrapers read them; values that were not measured are left out."""
    value = F.when(F.col("value") == F.floor("value"), F.col("value").cast("bigint").cast("string")).otherwise(F.col("value").cast("string"))
    label = F.when(F.coalesce(F.col("label"), F.lit("")) == "", "").otherwise(F.concat(F.lit('{label="'), F.replace(F.replace("label", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"}')))
    return metrics.filter("value is not null").select(F.concat("name", label, F.lit(" "), value).alias("line"))


def push(metrics: DataFrame, path: str) -> bool:
    """Writes metrics that were measured; never raises, and says whether it went well."""
    try:
        metrics.filter("value is not null").write.mode("append").json(path)
    except Exception:
        return False
    return True
