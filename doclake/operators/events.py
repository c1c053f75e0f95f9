"""Outcomes as one stream of events, and as log lines."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions.windows import check_range, window_array
from doclake.operators.stats import run_summary, scope_stats
from doclake.sources.logs import COUNTERS, event_line


def event_union(stored: DataFrame, unchanged: DataFrame, failed: DataFrame) -> DataFrame:
    """Stored, unchanged and failed records under one schema with ``event`` and ``outcome``."""

    def named(rows: DataFrame, event: str, outcome: str) -> DataFrame:
        return rows.withColumns({"event": F.lit(event), "outcome": F.lit(outcome)})

    return (
        named(stored, "record_stored", "stored")
        .unionByName(named(unchanged, "document_unchanged", "unchanged"), allowMissingColumns=True)
        .unionByName(named(failed, "record_failed", "failed"), allowMissingColumns=True)
    )


# The events and their fields, in order.
EVENT_FIELDS = {
    "run_started": ("start_date", "end_date", "partition_size", "partitions"),
    "bodies_discovered": ("bodies",),
    "partition_started": ("body", "partition", "total_results"),
    "record_stored": (
        "body",
        "identifier",
        "partition",
        "file_path",
        "file_hash",
        "document_type",
        "object_written",
        "inserted",
    ),
    "document_unchanged": ("url", "identifier", "body", "reason"),
    "rate_limited": ("url", "error_code", "retry_after"),
    "record_failed": ("url", "error_code", "reason", "body", "partition", "identifier"),
    "partition_summary": ("body", "partition", "records_found", "records_scraped", "failed"),
    "run_summary": ("records_found", "records_scraped", "failed"),
    "transform_started": ("partition",),
    "document_transformed": (
        "identifier",
        "body",
        "partition",
        "document_type",
        "file_path",
        "file_hash",
        "unchanged_content",
    ),
}
LEVELS = {"record_failed": "ERROR", "rate_limited": "WARNING"}


def event_lines(rows: DataFrame, event: str, ts: Column, logger: str, *more: str) -> DataFrame:
    """One JSON line per row in column ``value``, with the fields of the event, and ``more``."""
    line = event_line(
        ts.cast("string"),
        F.lit(LEVELS.get(event, "INFO")),
        F.lit(logger),
        F.lit(event),
        **{name: F.col(name) for name in (*EVENT_FIELDS[event], *more)},
    )
    return rows.select(line.alias("value"))


def run_started(spark: SparkSession, start: date | str, end: date | str, size: str) -> DataFrame:
    """One row: the range of a run and into how many windows it is cut."""
    first, last = check_range(start, end)
    windows = F.size(window_array(F.lit(first), F.lit(last), size)).cast("long")
    texts = [F.lit(str(v)).alias(n) for n, v in (("start_date", first), ("end_date", last), ("partition_size", size))]
    return spark.range(1).select(*texts, windows.alias("partitions"))


def bodies_discovered(bodies: DataFrame) -> DataFrame:
    """One row: the names of the bodies a run covers, by id. There are as many as checkboxes on a form."""
    listed = F.sort_array(F.collect_set(F.struct("body_id", "body")))
    return bodies.agg(F.transform(listed, lambda b: b["body"]).alias("bodies"))


def run_finished(started: DataFrame, counters: Mapping[str, int], reason: str = "finished") -> DataFrame:
    """One row: the counters that a run's own pass observed, and what the run was."""
    values = {name: F.lit(counters[name]).cast("long") for name in COUNTERS}
    return started.withColumns({**values, "reason": F.lit(reason)})


RUN_FIELDS = ("start_date", "end_date", "partition_size", "reason")


def ingest_log(
    decisions: DataFrame, ts: Column, logger: str = "landing", summary: DataFrame | None = None
) -> DataFrame:
    """The lines of an ingest run: one per record, one per scope, one for the run.

    ``summary`` is the run's row of ``run_finished``; without it the scopes are summed up.
    """
    rows = decisions.withColumn("url", F.col("document_url"))
    unchanged = rows.where("outcome = 'unchanged'").withColumn("reason", F.lit("http_validator"))
    scopes = scope_stats(decisions)
    parts = {
        "record_stored": rows.where("outcome = 'stored'"),
        "document_unchanged": unchanged,
        "record_failed": rows.where("outcome = 'failed'"),
        "partition_summary": scopes,
    }
    total = event_lines(run_summary(scopes), "run_summary", ts, logger) if summary is None else None
    total = event_lines(summary, "run_summary", ts, logger, *RUN_FIELDS) if total is None else total
    return _union(parts, ts, logger).unionByName(total)


def transform_log(
    outcomes: DataFrame, ts: Column, logger: str = "transformation", span: str | None = None
) -> DataFrame:
    """The lines of a transform run; a record's partition is its partition date.

    With ``span``, the range transformed, the run's start is a line and its summary names the range.
    """
    rows = outcomes.withColumn("partition", F.col("partition_date"))
    url = F.coalesce(F.nullif("document_url", F.lit("")), F.nullif("file_path", F.lit("")), F.lit(""))
    outcome = F.when(F.col("error_code").isNull(), "stored").otherwise("failed")
    scopes = scope_stats(rows.withColumn("outcome", outcome))
    parts = {
        "document_transformed": rows.where("error_code is null"),
        "record_failed": rows.where("error_code is not null").withColumn("url", url),
        "partition_summary": scopes,
    }
    total, lines = run_summary(scopes), _union(parts, ts, logger)
    if span is None:
        return lines.unionByName(event_lines(total, "run_summary", ts, logger))
    total = total.withColumn("partition", F.lit(span))
    started = event_lines(total, "transform_started", ts, logger)
    return lines.unionByName(started).unionByName(event_lines(total, "run_summary", ts, logger, "partition"))


def listing_log(listings: DataFrame, ts: Column, logger: str = "frontier") -> DataFrame:
    """A line for every first listing page: a scope's partition has been started."""
    return event_lines(listings.where("page = 1"), "partition_started", ts, logger)


def _union(parts: dict[str, DataFrame], ts: Column, logger: str) -> DataFrame:
    lines = [event_lines(rows, event, ts, logger) for event, rows in parts.items()]
    return reduce(DataFrame.unionByName, lines)
