"""Streaming forms; each must end where the batch form ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators.outcomes import triage, with_validation
from doclake.sources.store import Store
from doclake.sources.workspace import workspace
from doclake.streaming import decisions
from doclake.streaming.ingest import stream_ingest as start_ingest
from doclake.streaming.stats import current_scope_stats, stream_scope_stats as start_stats, weekly_scopes
from workload.inputs import AS_OF, DECIDED, FETCHES, fetches_of
from workload.registry import query, table
from workload.stats import _COUNTS


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")


@query(
    "stream_ingest",
    f"""WITH {DECIDED}
SELECT body, identifier, description, date, partition_date, file_path, file_hash, http_etag, document_type FROM landing""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, workspace(spark, "stream-store"))
    arriving = fetches_of(_event_stream(spark, sf_dir)).drop("ts")
    start_ingest(arriving, store, workspace(spark, "stream-state"), AS_OF).awaitTermination()
    return store.read("landing").select(
        "body", "identifier", "description", "date", "partition_date", "file_path", "file_hash",
        "http_etag", "document_type",
    )


@query(
    "stream_two_sources",
    f"""WITH {DECIDED}
SELECT body, identifier, description, date, partition_date, file_path, file_hash, http_etag, document_type FROM landing""",
)
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one store, each with a checkpoint and batch numbers of its own."""
    store = Store(spark, workspace(spark, "stream-store"))
    attempts = fetches_of(_event_stream(spark, sf_dir)).drop("ts")
    for part in (0, 1):
        arriving = attempts.where(F.crc32("identifier") % 2 == part)
        start_ingest(arriving, store, workspace(spark, "stream-state"), AS_OF).awaitTermination()
    return store.read("landing").select(
        "body", "identifier", "description", "date", "partition_date", "file_path", "file_hash",
        "http_etag", "document_type",
    )


@query(
    "stream_write_decisions",
    f"WITH {DECIDED} SELECT fetch_seq, body, identifier, file_path, file_hash, inserted, object_written FROM decided",
)
def stream_write_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts in four micro-batches, the third with a part of the first once more, decided with state."""
    attempts = fetches_of(table(spark, sf_dir, "events")).drop("ts")
    last = attempts.agg(F.max("fetch_seq")).head()[0]
    source, path, state = (workspace(spark, name) for name in ("arriving", "stream-decisions", "decision-state"))
    quarter = F.floor(F.col("fetch_seq") * 4 / (last + 1))
    arriving = spark.readStream.schema(attempts.schema).parquet(f"{source}/piece=*")
    usual = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, decisions.PROVIDER)
    try:
        decided = decisions.decide_stream(arriving)
        # The stream goes on from its checkpoint with all files of a piece, however many, as one batch.
        for piece in range(4):
            found = attempts.where(quarter == piece)
            if piece == 2:
                found = found.union(attempts.where((quarter == 0) & (F.col("fetch_seq") % 5 == 0)))
            found.write.parquet(f"{source}/piece={piece}")
            decisions.stream_decisions(decided, path, state).awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE) if usual is None else spark.conf.set(STATE_STORE, usual)
    found = spark.read.schema(decided.schema).parquet(path).where("not replayed")
    return found.select("fetch_seq", "body", "identifier", "file_path", "file_hash", "inserted", "object_written")


@query(
    "stream_scope_stats",
    f"WITH {FETCHES} SELECT body, partition, {_COUNTS} FROM checked GROUP BY body, partition",
)
def stream_scope_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = triage(fetches_of(_event_stream(spark, sf_dir)))
    checked = with_validation(seen.withColumn("triaged", F.col("outcome")))
    outcome = (
        F.when(F.col("triaged") == "unchanged", "unchanged")
        .when((F.col("triaged") == "failed") | F.col("error_code").isNotNull(), "failed")
        .otherwise("stored")
    )
    events = weekly_scopes(checked.withColumn("outcome", outcome), "ts", "body")
    updates = workspace(spark, "scope-updates")
    start_stats(events, updates, workspace(spark, "scope-state")).awaitTermination()
    return current_scope_stats(spark.read.parquet(updates))
