"""Outcome of each capture, and the failure rows that take the place of exceptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.functions.requests import failure_code, failure_reason
from doclake.functions.text import has_key
from doclake.schema import (
    BAD_NUMBER,
    EMPTY_IDENTIFIER,
    LANDING_FAILED,
    NO_PAYLOAD,
    REQUIRED_FIELDS,
)

UNCHANGED, FETCHED, FAILED = "unchanged", "fetched", "failed"

# Fields the caller has to bring; path and hash are computed on the way.
_GIVEN = tuple(name for name in REQUIRED_FIELDS if name not in ("file_path", "file_hash"))


def triage(captures: DataFrame) -> DataFrame:
    """Add ``outcome``: 304 is unchanged, 2xx is fetched, all else failed with code and reason."""
    status = F.col("status")
    outcome = (
        F.when(status == 304, UNCHANGED)
        .when(status.between(200, 299), FETCHED)
        .otherwise(FAILED)
    )
    failed = F.col("outcome") == FAILED
    return captures.withColumn("outcome", outcome).withColumns(
        {
            "error_code": F.when(failed, failure_code(status, F.col("error_code"))),
            "reason": F.when(failed, failure_reason(status, F.col("reason"))),
        }
    )


def request_failures(attempts: DataFrame, url: str = "document_url") -> DataFrame:
    """Failure rows of requests that stand for no record, as those for search and listing pages.

    Anything but 2xx failed. The rows have no scope, so no scope counts them.
    """
    status = F.col("status")
    none = F.lit(None).cast("string")
    return attempts.where(~F.coalesce(status.between(200, 299), F.lit(False))).select(
        F.col(url).alias("url"),
        failure_code(status, F.col("error_code")).alias("error_code"),
        failure_reason(status, F.col("reason")).alias("reason"),
        *[none.alias(name) for name in ("body", "partition", "identifier")],
    )


def with_validation(records: DataFrame) -> DataFrame:
    """Mark records that must not be written, before anything is written.

    ValidationError: a required field is null, the partition date is no ISO date (it names a
    folder), there is no payload, or the arrival number is null or negative. ValueError: nothing is
    left of an identifier.
    """
    incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in _GIVEN])
    undated = ~F.col("partition_date").rlike(r"^\d{4}-\d{2}-\d{2}\z")
    body, identifier = F.col("body"), F.col("identifier")
    empty = ~has_key(body) | ~has_key(identifier)
    absent = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in _GIVEN])
    empty_key = F.when(~has_key(body), body).otherwise(identifier)
    why = F.when(incomplete, F.concat(F.lit("missing "), absent))
    why = why.when(undated, "partition_date is no ISO date").when(
        empty, F.concat(F.lit(f"{EMPTY_IDENTIFIER}'"), empty_key, F.lit("'"))
    )
    unnumbered = F.coalesce(F.col("fetch_seq") < 0, F.lit(True))
    why = why.when(F.col("payload").isNull(), NO_PAYLOAD).when(unnumbered, BAD_NUMBER)
    invalid = F.when(incomplete | undated, "ValidationError").when(empty, "ValueError")
    code = invalid.when(F.col("payload").isNull() | unnumbered, "ValidationError")
    # The conditions are gone through once more only for what is invalid.
    reason = F.when(F.col("error_code").isNotNull(), F.concat(F.lit(LANDING_FAILED), why))
    return records.withColumn("error_code", code).withColumn("reason", reason)


def failures(rows: DataFrame, url: str = "document_url") -> DataFrame:
    """Failure rows of any frame that carries error_code and reason, by outcome where there is one."""
    failed = "outcome = 'failed'" if "outcome" in rows.columns else "error_code is not null"
    return rows.where(failed).select(
        F.col(url).alias("url"), "error_code", "reason", "body", "partition", "identifier"
    )
