"""The stateful processor of write decisions: plain rows, and one look at the state per identity and batch."""

from __future__ import annotations

from pyspark.sql import Row

from doclake.streaming import decisions
from doclake.streaming.decisions import LastWrite


class _State:
    def __init__(self, value=None):
        self.value, self.asked = value, 0

    def exists(self):
        self.asked += 1
        return self.value is not None

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked, self.value = self.asked + 1, value


def _rows(*rows):
    return iter([Row(body="A", identifier="U", fetch_seq=n, file_path=p, file_hash=h) for n, p, h in rows])


def test_an_identity_costs_two_calls_of_the_state():
    processor = LastWrite()
    processor.last = _State(("a", "x", 5))
    found = list(processor.handleInputRows(("A", "U"), _rows((8, "a", "y"), (5, "a", "x"), (7, "a", "x"), (9, "b", "y")), None))
    assert [(r.fetch_seq, r.object_written, r.inserted, r.replayed) for r in found] == [
        (5, False, False, True), (7, False, False, False), (8, True, False, False), (9, True, False, False),
    ]
    assert processor.last.value == ("b", "y", 9) and processor.last.asked == 2


def test_decisions_go_on_from_what_is_stored(spark, capture, tmp_path):
    usual = "spark.sql.streaming.stateStore.providerClass"
    stored = spark.createDataFrame([("Tribunal", "T-1", "old", "old")], "body string, identifier string, file_path string, file_hash string")
    source, path = str(tmp_path / "arriving"), str(tmp_path / "decided")
    (tmp_path / "arriving").mkdir()
    arriving = spark.readStream.schema(capture({}).schema).parquet(source)
    spark.conf.set(usual, decisions.PROVIDER)
    try:
        decided = decisions.decide_stream(arriving, stored)
        for piece in ([{"identifier": "T-1"}, {"identifier": "T-2"}], [{"identifier": "T-2"}, {"identifier": "T-2"}]):
            capture(*piece).write.mode("append").parquet(source)
            decisions.stream_decisions(decided, path, str(tmp_path / "state")).awaitTermination()
    finally:
        spark.conf.unset(usual)
    rows = spark.read.schema(decided.schema).parquet(path).collect()
    found = sorted((r.identifier, r.fetch_seq, r.object_written, r.inserted, r.replayed) for r in rows)
    assert found == [
        ("T-1", 0, True, False, False),
        ("T-2", 0, False, False, True),
        ("T-2", 1, False, False, True),
        ("T-2", 1, True, True, False),
    ]
