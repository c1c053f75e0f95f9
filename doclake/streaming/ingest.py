"""Landing as captures arrive."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from doclake.plans.ingest import run_ingest
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.sources.store import Store


def stream_ingest(
    captures: DataFrame,
    store: Store,
    checkpoint: str,
    as_of: str | None = None,
    profile: SourceProfile = DEFAULT_PROFILE,
) -> StreamingQuery:
    """Ingest every micro-batch into the store, each exactly once.

    The commit carries the batch number under the id of the stream, which Spark keeps in the
    checkpoint. So a batch replayed after a crash that came between commit and checkpoint is
    recognised and skipped, while another stream, or one with a new checkpoint, counts for itself.
    Without ``as_of`` the clock gives scraped_at.
    """

    def land(batch: DataFrame, number: int) -> None:
        name = store.spark.read.json(f"{checkpoint.rstrip('/')}/metadata").head()["id"]
        done = store.mark(name)
        if done is not None and number <= done:
            return
        run_ingest(store, batch, as_of or datetime.now(UTC).isoformat(), profile, {name: number})

    writer = captures.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
