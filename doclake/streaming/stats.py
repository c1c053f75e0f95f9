"""Live scope counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from doclake.operators.stats import SCOPE, scope_stats


def weekly_scopes(events: DataFrame, time: str, body: str) -> DataFrame:
    """Events with body and a weekly partition label; weeks start on Monday."""
    week = F.window(time, "7 days", startTime="4 days")  # 1970-01-01 was a Thursday
    days = [F.date_format(F.col(f"week.{edge}"), "yyyy-MM-dd") for edge in ("start", "end")]
    return events.withColumn("week", week).select(
        F.col(body).alias("body"), F.concat_ws("/", *days).alias("partition"), "outcome"
    )


def stream_scope_stats(events: DataFrame, updates: str, checkpoint: str) -> StreamingQuery:
    """Write the changed counters of every micro-batch under ``updates/epoch=N``.

    State is one row per scope. A replayed batch overwrites its own folder.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/epoch={number}")

    writer = scope_stats(events).writeStream.outputMode("update").foreachBatch(put)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_scope_stats(updates: DataFrame) -> DataFrame:
    """The latest counters of every scope from the updates written so far."""
    values = [c for c in updates.columns if c not in (*SCOPE, "epoch")]
    latest = F.max_by(F.struct(*values), F.col("epoch")).alias("latest")
    return updates.groupBy(*SCOPE).agg(latest).select(*SCOPE, "latest.*")
