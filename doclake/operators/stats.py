"""Counters per scope and per run. All are aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.schema import NO_SCOPE
from doclake.sources.logs import COUNTERS

SCOPE = ("body", "partition")
FOUND = ("stored", "unchanged", "failed", "skipped")


def _counts() -> list[Column]:
    outcome = F.col("outcome")
    return [
        F.count_if(outcome.isin(*FOUND)).alias("records_found"),
        F.count_if(outcome.isin("stored", "unchanged")).alias("records_scraped"),
        F.count_if(outcome == "failed").alias("failed"),
        F.count_if(outcome == "skipped").alias("skipped"),
    ]


def run_counters() -> list[Column]:
    """The counters of a whole run, as aggregates over its outcomes; for ``DataFrame.observe``."""
    return _counts()


def _totals() -> list[Column]:
    names = (*COUNTERS, "skipped")
    return [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names]


def scope_stats(events: DataFrame, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    """found, scraped, failed and skipped per scope; a record without body or partition counts too."""
    named = events.withColumns({c: F.coalesce(F.col(c), F.lit(NO_SCOPE)) for c in scope})
    return named.groupBy(*scope).agg(*_counts())


def scope_stats_dense(
    events: DataFrame, scopes: DataFrame, scope: tuple[str, ...] = SCOPE
) -> DataFrame:
    """Every scope whose listing was seen, with zeros where nothing was found."""
    counted = scope_stats(events, scope)
    names = [c for c in counted.columns if c not in scope]
    seen = scopes.select(*scope).distinct()
    return seen.join(counted, list(scope), "left").na.fill(0, names)


def scope_rollup(events: DataFrame) -> DataFrame:
    """Counts per scope, per body and in total; ``level`` is 0, 1 and 3.

    The rollup is over the scopes' counts, so its threefold expansion never touches the events.
    """
    level = F.grouping_id().cast("bigint").alias("level")
    return scope_stats(events).rollup(*SCOPE).agg(*_totals(), level)


def run_summary(scopes: DataFrame) -> DataFrame:
    return scopes.agg(*_totals())


def scope_balance(scopes: DataFrame) -> DataFrame:
    """Every scope with a flag: found = scraped + failed + skipped."""
    accounted = F.col("records_scraped") + F.col("failed") + F.col("skipped")
    return scopes.withColumn("balanced", F.col("records_found") == accounted)


def ingest_counters(events: DataFrame) -> DataFrame:
    """(name, value) rows: objects written, the two kinds of unchanged, inserted, updated."""
    stored = F.col("outcome") == "stored"
    counters = {
        "landing/objects_written": stored & F.col("object_written"),
        "landing/unchanged_hash": stored & ~F.col("object_written"),
        "landing/unchanged_validator": F.col("outcome") == "unchanged",
        "landing/records_inserted": stored & F.col("inserted"),
        "landing/records_updated": stored & ~F.col("inserted"),
    }
    one_row = events.agg(*[F.count_if(test).alias(name) for name, test in counters.items()])
    names = list(counters)
    return one_row.unpivot([], names, "name", "value")


def failure_breakdown(failures: DataFrame, *by: str) -> DataFrame:
    return failures.groupBy("error_code", *by).agg(F.count("*").alias("failures"))


def log_run_summary(events: DataFrame) -> DataFrame:
    """The last run_summary event's counters; zeros for missing fields and when there is none."""
    last = F.max_by(F.struct(*COUNTERS), F.col("line_no")).alias("last")
    summary = events.where("event = 'run_summary'").agg(last)
    return summary.select(
        *[F.coalesce(F.col(f"last.{n}"), F.lit(0)).cast("bigint").alias(n) for n in COUNTERS]
    )


def run_gate(summary: DataFrame, exit_code: int = 0) -> DataFrame:
    """Whether a run counts as failed: nothing came through and something failed, or a bad exit."""
    nothing = (F.col("records_scraped") == 0) & (F.col("failed") > 0)
    return summary.withColumn("run_failed", nothing | F.lit(exit_code != 0))
