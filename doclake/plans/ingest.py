"""Captures to landing: triage, type, normalise, hash, decide, write, upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from doclake.functions.content import (
    content_type_of,
    detect_document_type,
    file_hash,
    normalize_payload,
)
from doclake.functions.text import landing_key
from doclake.operators.events import event_union
from doclake.operators.identity import latest_per_identity, merge, write_decisions
from doclake.operators.stats import run_counters
from doclake.operators.outcomes import FAILED, FETCHED, UNCHANGED, triage, with_validation
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.schema import IDENTITY, LANDING_FAILED, LANDING_SCHEMA, REPEATED_NUMBER
from doclake.session import compiled
from doclake.sources.index import LANDING_IDENTITY, LANDING_OBJECT
from doclake.sources.landing import find_many
from doclake.sources.store import Run, Store
from doclake.sources.workspace import materialize


# What classification adds to a record, and a record that is not decided lacks.
MADE = ("document_type", "file_hash", "file_path")
# Objects to write up to which their slim rows, of some hundred bytes, are sent to the payloads.
FEW = 100_000


def classify(captures: DataFrame, profile: SourceProfile = DEFAULT_PROFILE) -> DataFrame:
    """Add document_type, file_hash and file_path; the payload becomes the normalised one."""
    typed = captures.withColumn(
        "document_type", detect_document_type(F.col("content_type"), F.col("payload"))
    )
    normal = typed.withColumn(
        "payload", normalize_payload(F.col("payload"), F.col("document_type"), profile)
    )
    return normal.withColumns(
        {
            "file_hash": file_hash(F.col("payload")),
            "file_path": landing_key(F.col("body"), F.col("identifier"), F.col("document_type")),
        }
    )


def slim_captures(captures: DataFrame, profile: SourceProfile = DEFAULT_PROFILE) -> DataFrame:
    """One row per capture without its payload: outcome, failure, and what the payload gave.

    One projection over one scan. A payload is typed, normalised and hashed where it lies, and only
    if its capture was fetched and is valid; ``MADE`` is null for all others.
    """
    seen = triage(captures)
    fetched = F.col("outcome") == FETCHED
    checked = with_validation(seen.withColumnsRenamed({"error_code": "_code", "reason": "_reason"}))
    valid = fetched & F.col("error_code").isNull()
    judged = checked.withColumn("_valid", valid).withColumns(
        {
            "payload": F.when(F.col("_valid"), F.col("payload")),
            "error_code": F.when(fetched, F.col("error_code")).otherwise(F.col("_code")),
            "reason": F.when(fetched, F.col("reason")).otherwise(F.col("_reason")),
            "outcome": F.when(fetched & ~F.col("_valid"), FAILED).otherwise(F.col("outcome")),
        }
    )
    made = classify(judged, profile)
    return made.withColumns({c: F.when(F.col("_valid"), F.col(c)) for c in MADE}).drop("payload", "_valid", "_code", "_reason")


def decide(
    captures: DataFrame,
    stored: DataFrame,
    profile: SourceProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """One slim row per capture: outcome, failure if any, and the write decision if stored.

    The captures are scanned once; what is decided starts from the slim rows, which are written. A
    capture that breaks the contract (see ``with_validation``, or a number used twice for one
    identity) is a failure like any other, so every capture has its row.
    """
    with compiled(captures.sparkSession):
        slim = materialize(slim_captures(captures, profile), "slim-captures")
    return decide_slim(slim, stored)


def decide_slim(slim: DataFrame, stored: DataFrame) -> DataFrame:
    """``decide`` for written rows of ``slim_captures``."""
    decided = write_decisions(slim.where(F.col("outcome") == FETCHED).drop("outcome"), stored)
    events = event_union(
        decided,
        slim.where(F.col("outcome") == UNCHANGED).drop("outcome", *MADE),
        slim.where(F.col("outcome") == FAILED).drop("outcome", *MADE),
    )
    twice = F.coalesce("repeated", F.lit(False))
    events = events.withColumns(
        {
            "event": F.when(twice, "record_failed").otherwise(F.col("event")),
            "outcome": F.when(twice, FAILED).otherwise(F.col("outcome")),
            "error_code": F.when(twice, "ValidationError").otherwise(F.col("error_code")),
            "reason": F.when(twice, LANDING_FAILED + REPEATED_NUMBER).otherwise(F.col("reason")),
            **{c: F.when(~twice, F.col(c)) for c in ("object_written", "inserted", *MADE)},
        }
    ).drop("repeated")
    return events.withColumn(
        "object_partition", F.when(F.col("object_written"), F.col("partition_date"))
    )


def landing_after(stored: DataFrame, decisions: DataFrame, as_of: str) -> DataFrame:
    """The landing table after a batch, plus ``action``.

    ``object_partition`` says where the current object lies: the partition of the identity's last
    actual write, which for an unchanged record is not the partition of the record itself.
    """
    records = decisions.where("outcome = 'stored'").withColumn("scraped_at", F.lit(as_of))
    names = [f.name for f in LANDING_SCHEMA.fields]
    latest = latest_per_identity(
        records.select("fetch_seq", *names, F.col("object_partition").alias("_written")),
        written_in=F.max_by("_written", F.when(F.col("_written").isNotNull(), F.col("fetch_seq"))),
    ).drop("_written", "fetch_seq")
    latest = latest.withColumnRenamed("written_in", "object_partition")
    return merge(stored, latest, keep_when_null=["object_partition"])


def last_writes(decisions: DataFrame) -> DataFrame:
    """The last actual write of every key, without content: what a batch leaves behind."""
    last = F.struct("fetch_seq", *IDENTITY, "document_type", "file_hash", "partition_date")
    picked = decisions.where("object_written").groupBy("file_path")
    return picked.agg(F.max_by(last, F.struct("fetch_seq", *IDENTITY)).alias("last")).select("file_path", "last.*")


def objects_to_write(
    captures: DataFrame,
    picked: DataFrame,
    profile: SourceProfile = DEFAULT_PROFILE,
    buckets: int | None = None,
) -> DataFrame:
    """The objects of ``last_writes``, with content.

    The key of a capture, identity and arrival number, is unique among what was decided; a number
    alone need not be. With ``buckets`` the payloads are dealt to the buckets of their object key
    first, so that the join and a bucketed write move them no more; without, the join is left to
    Spark, which is right where the picked rows are few and are sent to the payloads.
    """
    payloads = captures.select(*IDENTITY, "fetch_seq", "payload", "status", "content_type")
    # A capture that was not fetched may share identity and number with one that was.
    fetched = payloads.where(F.col("status").between(200, 299)).where("payload is not null").drop("status")
    if buckets is None:
        joined = fetched.drop("content_type").join(picked, [*IDENTITY, "fetch_seq"])
    else:
        typed = fetched.withColumn("_type", detect_document_type(F.col("content_type"), F.col("payload"))).drop("content_type")
        keyed = typed.withColumn("_path", landing_key(F.col("body"), F.col("identifier"), F.col("_type"))).drop("_type")
        dealt = keyed.where("_path is not null").repartition(buckets, "_path")
        renamed = picked.withColumnsRenamed({c: f"_{c}" for c in (*IDENTITY, "fetch_seq")})
        # Compared by order, not equality: the join's only key is the one the payloads are dealt by.
        same = [(F.col(c) <= F.col(f"_{c}")) & (F.col(c) >= F.col(f"_{c}")) for c in (*IDENTITY, "fetch_seq")]
        joined = dealt.join(renamed, reduce(Column.__and__, same, F.col("_path") == F.col("file_path")))
    return joined.select(
        "file_path",
        normalize_payload(F.col("payload"), F.col("document_type"), profile).alias("content"),
        content_type_of(F.col("document_type")).alias("content_type"),
        "file_hash",
        "fetch_seq",
        "partition_date",
    )


def run_ingest(
    store: Store,
    captures: DataFrame,
    as_of: str,
    profile: SourceProfile = DEFAULT_PROFILE,
    marks: dict[str, int] | None = None,
    observed: list[Observation] | None = None,
) -> DataFrame:
    """Ingest a batch into the store and commit it; returns the decisions as a written table.

    What is stored of the batch's identities comes from the index: only its touched buckets are read.
    If another run commits first, the batch is decided once more against what that one stored. The
    counters of ``run_counters`` come with the pass that writes the decisions: the last of ``observed``.
    """

    def ingest(run: Run) -> DataFrame:
        slim = run.stage("slim-captures", slim_captures(captures, profile))
        known = run.stage("known", run.find(LANDING_IDENTITY, slim))
        decided = decide_slim(slim, known)
        if observed is not None:
            observed.append(Observation())
            decided = decided.observe(observed[-1], *run_counters())
        decisions = run.stage("decisions", decided)
        picked = run.stage("picked", last_writes(decisions))
        count = picked.count()
        if count:
            buckets = None if count <= FEW else run.buckets
            objects = objects_to_write(captures, F.broadcast(picked) if buckets is None else picked, profile, buckets)
            written = run.write_objects("landing", objects, dealt=buckets is not None)
            place = {"object_run": F.lit(run.number).cast("long"), "object_folder": F.lit(run.folder)}
            run.post(LANDING_OBJECT, written.withColumnRenamed("partition_date", "object_partition").withColumns(place))
        records = decisions.where("outcome = 'stored'")
        run.merge(
            "landing",
            records,
            find_many(known, records),
            lambda stored: landing_after(stored, decisions, as_of).drop("action"),
        )
        run.post(LANDING_IDENTITY, latest_per_identity(records.select("fetch_seq", *LANDING_IDENTITY.schema.names)))
        return decisions

    with compiled(captures.sparkSession):
        return store.attempt(ingest, marks)
