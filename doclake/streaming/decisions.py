"""Write decisions on a stream, with the last write of every identity in Spark's state store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

import doclake
from doclake.operators.outcomes import FETCHED
from doclake.plans.ingest import slim_captures
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.schema import IDENTITY

# The processor travels to the workers with its code.
cloudpickle.register_pickle_by_value(doclake)

STATE = "file_path string, file_hash string, fetch_seq long"
DECISION = "body string, identifier string, fetch_seq long, file_path string, file_hash string, object_written boolean, inserted boolean, replayed boolean"
# The state stores that can hold named state per key.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastWrite(StatefulProcessor):
    """One value per identity: path, hash and number of its last write."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update((initialState["file_path"], initialState["file_hash"], int(initialState["fetch_seq"])))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Most identities have a few rows in a batch: plain rows, and one look at the state.
        arrived = sorted(rows, key=lambda row: row["fetch_seq"])
        before = self.last.get()
        for row in arrived:
            number, path, digest = row["fetch_seq"], row["file_path"], row["file_hash"]
            again = before is not None and number <= before[2]
            inserted = before is None
            written = not again and (inserted or (path, digest) != (before[0], before[1]))
            if not again:
                before = (path, digest, number)
            yield Row(
                body=key[0], identifier=key[1], fetch_seq=number, file_path=path, file_hash=digest,
                object_written=written, inserted=inserted, replayed=again,
            )
        self.last.update(tuple(before))

    def close(self) -> None:
        pass


def decide_stream(captures: DataFrame, stored: DataFrame | None = None, profile: SourceProfile = DEFAULT_PROFILE) -> DataFrame:
    """Decisions for the valid fetched captures of a stream, as the batch makes them in arrival order.

    The payload is hashed where it is read; what is kept is one slim value per identity, begun with
    ``stored`` (identity, file_path, file_hash) where given. A capture that is not newer than its
    identity's last one is ``replayed``: it has been decided, or came after a later one, and nothing is
    written for it. A micro-batch's captures of one identity are put in order in memory, so the source's
    limit per trigger bounds them. Needs the state store provider ``PROVIDER``.
    """
    slim = slim_captures(captures, profile).where(F.col("outcome") == FETCHED)
    keyed = slim.select(*IDENTITY, "fetch_seq", "file_path", "file_hash").groupBy(*IDENTITY)
    initial = None
    if stored is not None:
        before = stored.select(*IDENTITY, "file_path", "file_hash", F.lit(-1).cast("long").alias("fetch_seq"))
        initial = before.groupBy(*IDENTITY)
    decided = keyed.transformWithState(
        statefulProcessor=LastWrite(), outputStructType=DECISION, outputMode="Append", timeMode="None", initialState=initial
    )
    return decided


def stream_decisions(decisions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the decisions of every micro-batch under ``path/epoch=N``; a replayed batch replaces its own."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={number}")

    writer = decisions.writeStream.foreachBatch(put).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
