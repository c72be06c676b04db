"""Section names of annual and quarterly reports by item number, and the order of items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Section names by item of an annual report.
ANNUAL = {
    "1": "Business",
    "1A": "Risk Factors",
    "1B": "Unresolved Staff Comments",
    "1C": "Cybersecurity",
    "2": "Properties",
    "3": "Legal Proceedings",
    "4": "Mine Safety Disclosures",
    "5": "Market for Registrant's Common Equity",
    "6": "Selected Financial Data",
    "7": "Management's Discussion and Analysis",
    "7A": "Quantitative and Qualitative Disclosures About Market Risk",
    "8": "Financial Statements",
    "9": "Changes in and Disagreements with Accountants",
    "9A": "Controls and Procedures",
    "9B": "Other Information",
    "9C": "Foreign Jurisdictions Preventing Inspections",
    "10": "Directors and Corporate Governance",
    "11": "Executive Compensation",
    "12": "Security Ownership",
    "13": "Certain Relationships and Related Transactions",
    "14": "Principal Accountant Fees and Services",
    "15": "Exhibits and Financial Statement Schedules",
    "16": "Form 10-K Summary",
}
#: Section names by item of a quarterly report.
QUARTERLY = {
    "1": "Financial Statements (unaudited)",
    "2": "Management's Discussion and Analysis",
    "3": "Quantitative and Qualitative Disclosures About Market Risk",
    "4": "Controls and Procedures",
    "1A": "Risk Factors",
    "5": "Other Information",
    "6": "Exhibits and Financial Statement Schedules",
}
#: The sections most asked for.
PRIMARY = ("Business", "Risk Factors", "Management's Discussion and Analysis", "Financial Statements", "Legal Proceedings", "Controls and Procedures", "Financial Statements (unaudited)")


def item_key(item: Column) -> Column:
    """An item as its number and letter: upper case, without the word and the signs around."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.trim(item)), "^ITEM", ""), r"^[ .:]+|[ .:]+$", ""))


def section(item: Column, form: Column) -> Column:
    """The section of an item in a form; Unknown for null and for other items."""
    def lookup(names: dict[str, str]) -> Column:
        return F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), item_key(item))

    found = F.when(F.upper(form).startswith("10-Q"), lookup(QUARTERLY)).otherwise(lookup(ANNUAL))
    return F.coalesce(F.when(item.isNotNull(), found), F.lit("Unknown"))


def is_primary(name: Column) -> Column:
    return name.isin(*PRIMARY)


def item_order(item: Column) -> Column:
    """(number, letter) by which items sort; anything else after all of them, by itself."""
    up = F.upper(item)
    proper = up.rlike("^[0-9]+[A-C]?$")
    return F.struct(
        F.when(proper, F.regexp_extract(up, "^([0-9]+)", 1).cast("int")).otherwise(999).alias("number"),
        F.when(proper, F.regexp_extract(up, "([A-C]?)$", 1)).otherwise(up).alias("letter"),
    )
