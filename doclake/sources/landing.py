"""Scans of a landing (or transformed) metadata table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def iso(value: date | str) -> str:
    return value if isinstance(value, str) else value.isoformat()


def scan_range(landing: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Records with start <= partition_date < end; prunes when that is the partition column."""
    day = F.col("partition_date")
    return landing.where((day >= iso(start)) & (day < iso(end)))


def ordered(records: DataFrame) -> DataFrame:
    """Order of a cursor over landing; ``body`` breaks the ties an identifier alone leaves."""
    return records.orderBy("partition_date", "identifier", "body")


def find(landing: DataFrame, body: str, identifier: str) -> DataFrame:
    return landing.where((F.col("body") == body) & (F.col("identifier") == identifier))


def find_many(landing: DataFrame, identities: DataFrame) -> DataFrame:
    """The set form of a point lookup: stored records of the given identities."""
    wanted = identities.select("body", "identifier").distinct()
    return landing.join(wanted, ["body", "identifier"], "left_semi")
