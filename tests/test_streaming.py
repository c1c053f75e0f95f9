from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from doclake.plans.ingest import run_ingest
from doclake.sources.captures import read_captures, stream_captures
from doclake.sources.store import Store
from doclake.streaming.ingest import stream_ingest
from doclake.streaming.stats import current_scope_stats, stream_scope_stats, weekly_scopes

AS_OF = "2024-06-01T00:00:00+00:00"


def _history(capture):
    rows = []
    for i in range(24):
        rows.append({"identifier": f"T-{i % 5}", "payload": f"<p>{(i // 5) % 2}</p>".encode(), "status": 304 if i % 7 == 6 else 200})
    return capture(*rows)


@pytest.mark.parametrize("pieces", [1, 3, 4])
def test_any_split_into_batches_ends_where_one_batch_ends(spark, capture, tmp_path, pieces):
    rows = _history(capture)
    batch = Store(spark, str(tmp_path / "batch"))
    run_ingest(batch, rows, AS_OF)
    stream, source = Store(spark, str(tmp_path / "stream")), str(tmp_path / "captures")
    for piece in range(pieces):
        inside = (F.col("fetch_seq") * pieces / 24).cast("int") == piece
        rows.where(inside).coalesce(1).write.mode("append").parquet(source)
        arriving = stream_captures(spark, source, files_per_batch=1)
        stream_ingest(arriving, stream, str(tmp_path / "state"), AS_OF).awaitTermination()
    assert read_captures(spark, source).count() == 24
    assert sorted(stream.read("landing").collect()) == sorted(batch.read("landing").collect())


def test_captures_read_the_same_from_every_format(spark, capture, tmp_path):
    rows = _history(capture)
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        rows.write.format(fmt).save(path)
        assert sorted(read_captures(spark, path, fmt).collect()) == sorted(rows.collect())


def test_a_replayed_batch_is_skipped(spark, capture, tmp_path):
    store, source, state = Store(spark, str(tmp_path / "zones")), str(tmp_path / "captures"), tmp_path / "state"
    _history(capture).coalesce(1).write.parquet(source)
    arriving = stream_captures(spark, source)
    stream_ingest(arriving, store, str(state), "once").awaitTermination()
    run, objects = store.state()[0], store.objects("landing").count()
    # A crash between the store's commit and the checkpoint's: the stream does not know it is done.
    (state / "commits" / "0").unlink()
    (state / "commits" / ".0.crc").unlink(missing_ok=True)
    stream_ingest(arriving, store, str(state), "twice").awaitTermination()
    assert (store.state()[0], store.objects("landing").count()) == (run, objects)
    assert {r.scraped_at for r in store.read("landing").collect()} == {"once"}


def test_another_stream_counts_for_itself(spark, capture, tmp_path):
    """Its batches start at 0 again, and are not taken for those of the first."""
    store = Store(spark, str(tmp_path / "zones"))
    for name in ("A", "B"):
        source = str(tmp_path / name)
        capture({"identifier": name}).coalesce(1).write.parquet(source)
        stream_ingest(stream_captures(spark, source), store, str(tmp_path / f"state-{name}"), AS_OF).awaitTermination()
    # A new checkpoint on the first source is a new stream too: it ingests again, changing nothing.
    again = stream_ingest(stream_captures(spark, str(tmp_path / "A")), store, str(tmp_path / "state-new"), "later")
    again.awaitTermination()
    assert {r.identifier: r.scraped_at for r in store.read("landing").collect()} == {"A": "later", "B": AS_OF}
    assert store.objects("landing").count() == 2


def test_live_counters(spark, tmp_path):
    source = str(tmp_path / "events")
    schema = "ts timestamp, kind string, outcome string"
    for day, outcome in (("2024-01-01", "stored"), ("2024-01-07", "failed"), ("2024-01-08", "stored")):
        frame = spark.createDataFrame([(day, "A", outcome)] * 3, "ts string, kind string, outcome string")
        frame.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    updates = str(tmp_path / "updates")
    stream_scope_stats(weekly_scopes(events, "ts", "kind"), updates, str(tmp_path / "state")).awaitTermination()
    rows = {r.partition: r for r in current_scope_stats(spark.read.parquet(updates)).collect()}
    assert (rows["2024-01-01/2024-01-08"].records_found, rows["2024-01-01/2024-01-08"].failed) == (6, 3)
    assert rows["2024-01-08/2024-01-15"].records_scraped == 3
