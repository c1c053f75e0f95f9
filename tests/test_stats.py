from __future__ import annotations

from pyspark.sql import functions as F

from doclake.operators import events, stats
from doclake.sources import logs


def _events(spark, scopes):
    rows = []
    for body, partition, stored, failed in scopes:
        rows += [(body, partition, "stored")] * stored + [(body, partition, "failed")] * failed
    return spark.createDataFrame(rows, "body string, partition string, outcome string")


def test_run_totals_are_scope_sums(spark):
    scopes = stats.scope_stats(_events(spark, [("A", "p", 8, 2), ("B", "p", 5, 0), (None, None, 0, 3)]))
    total = stats.run_summary(scopes).head()
    # The records without scope count as well, under a scope of their own.
    assert (total.records_found, total.records_scraped, total.failed) == (18, 13, 5)
    assert scopes.where("body = 'None' and partition = 'None'").head().failed == 3
    assert all(r.balanced for r in stats.scope_balance(scopes).collect())


def test_an_empty_scope_is_reported(spark):
    seen = spark.createDataFrame([("A", "p"), ("B", "p"), ("A", "p")], "body string, partition string")
    rows = {r.body: r for r in stats.scope_stats_dense(_events(spark, [("A", "p", 1, 0)]), seen).collect()}
    assert (rows["B"].records_found, rows["B"].failed) == (0, 0)
    assert rows["A"].records_found == 1


def test_nothing_at_all_sums_to_zero(spark):
    total = stats.run_summary(stats.scope_stats(_events(spark, [("A", "p", 1, 0)]).where("false"))).head()
    assert (total.records_found, total.records_scraped, total.failed) == (0, 0, 0)


def test_gate(spark):
    def gate(scraped, failed, code=0):
        one = spark.createDataFrame([(scraped + failed, scraped, failed)], "records_found long, records_scraped long, failed long")
        return stats.run_gate(one, code).head().run_failed

    assert gate(0, 1) and not gate(1, 1) and not gate(0, 0) and gate(1, 0, code=1)


def _summary(spark, lines):
    frame = spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")
    row = stats.log_run_summary(logs.parse_log_events(frame)).head()
    return (row.records_found, row.records_scraped, row.failed)


def test_summary_from_log_lines(spark):
    noise = ["not json", '{"event": "partition_summary", "records_found": 9}']
    assert _summary(spark, [*noise, '{"event": "run_summary", "records_found": 45, "records_scraped": 44, "failed": 1}']) == (45, 44, 1)
    assert _summary(spark, ["{}"]) == (0, 0, 0)
    assert _summary(spark, ["[1, 2]", '"run_summary"', '{"event": "run_summary", "records_found": 120, "records_scraped": 120}']) == (120, 120, 0)
    assert _summary(spark, ['{"event": "run_summary", "records_found": 1}', '{"event": "run_summary", "records_found": 2}', '{"event": "run_summary", "records_found": 3} trailing']) == (2, 0, 0)


def test_event_lines_round_trip_through_text(spark, tmp_path):
    rows = spark.createDataFrame([("u", "404", 'say "hi"\n', "B", "p", None)], "url string, error_code string, reason string, body string, partition string, identifier string")
    lines = events.event_lines(rows, "record_failed", F.lit("2024"), "landing")
    logs.write_event_lines(lines, str(tmp_path / "log"))
    back = logs.parse_log_events(logs.read_log_lines(spark, str(tmp_path / "log"))).head()
    assert (back.event, back.level, back.fields["reason"]) == ("record_failed", "ERROR", 'say "hi"\n')
    assert back.fields["identifier"] is None and "identifier" in back.fields


def test_line_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text("".join(f'{{"event": "run_summary", "records_found": {i}}}\n' for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = logs.read_log_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 1
        assert stats.log_run_summary(logs.parse_log_events(lines)).head().records_found == 4999
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
