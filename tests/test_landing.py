from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from doclake.operators.frontier import document_plan, rate_limited, retry_worklist, suppress_requests
from doclake.operators.identity import lanes, latest_per_identity, merge, upsert, write_decisions
from doclake.operators.outcomes import failures, triage, with_validation
from doclake.operators.stats import ingest_counters, run_summary, scope_stats
from doclake.plans.ingest import decide, landing_after, last_writes, objects_to_write, run_ingest
from doclake.sources.store import METADATA, Store

AS_OF = "2024-06-01T00:00:00+00:00"


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], METADATA["landing"])


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "zones"))


def counters(decisions):
    return {r.name.removeprefix("landing/"): r.value for r in ingest_counters(decisions).collect()}


def ten(capture, **changes):
    rows = [
        {
            "identifier": f"T-{i}",
            "document_url": f"https://example.test/t-{i}.html",
            "payload": f"<html>decision {i}</html>".encode(),
        }
        for i in range(10)
    ]
    for index, change in changes.items():
        rows[int(index.removeprefix("at"))].update(change)
    return capture(*rows)


def test_second_run_writes_nothing(store, capture):
    first = run_ingest(store, ten(capture), AS_OF)
    assert counters(first) == {
        "objects_written": 10, "unchanged_hash": 0, "unchanged_validator": 0, "records_inserted": 10, "records_updated": 0,
    }
    again = run_ingest(store, ten(capture), "later")
    assert counters(again) == {
        "objects_written": 0, "unchanged_hash": 10, "unchanged_validator": 0, "records_inserted": 0, "records_updated": 10,
    }
    assert store.read("landing").count() == 10
    assert store.objects("landing").count() == 10
    assert {r.scraped_at for r in store.read("landing").collect()} == {"later"}


def test_one_changed_payload_is_one_write(store, capture):
    run_ingest(store, ten(capture), AS_OF)
    changed = run_ingest(store, ten(capture, at3={"payload": b"<html>revised</html>"}), AS_OF)
    assert counters(changed)["objects_written"] == 1
    row = store.read("landing").where("identifier = 'T-3'").join(store.objects("landing"), "file_hash").head()
    assert bytes(row.content) == b"<html>revised</html>"
    assert store.read("landing").count() == 10


def test_not_modified_is_scraped_but_not_upserted(store, capture):
    run_ingest(store, ten(capture), AS_OF)
    same = ten(capture).withColumns({"status": F.lit(304), "payload": F.lit(None).cast("binary")})
    decisions = run_ingest(store, same, "later")
    assert counters(decisions)["unchanged_validator"] == 10
    total = run_summary(scope_stats(decisions)).head()
    assert (total.records_found, total.records_scraped, total.failed) == (10, 10, 0)
    assert {r.scraped_at for r in store.read("landing").collect()} == {AS_OF}


def test_invalid_records_fail_before_any_write(store, capture):
    rows = ten(capture, at0={"identifier": "///"}, at1={"date": None}, at2={"status": 500}, at3={"status": None, "error_code": "TimeoutError", "reason": "slow"})
    decisions = run_ingest(store, rows, AS_OF)
    failed = {r.fetch_seq: (r.error_code, r.reason) for r in decisions.where("outcome = 'failed'").collect()}
    assert failed == {
        0: ("ValueError", "landing write failed: identifier is empty after sanitization: '///'"),
        1: ("ValidationError", "landing write failed: missing date"),
        2: ("500", "http error 500"),
        3: ("timeout", "slow"),
    }
    total = run_summary(scope_stats(decisions)).head()
    assert (total.records_found, total.records_scraped, total.failed) == (10, 6, 4)
    assert store.objects("landing").count() == store.read("landing").count() == 6


@pytest.mark.parametrize(
    ("first", "second"),
    [
        (b"<p>x</p><!-- Elapsed time: 0 -->", b"<p>x</p><!-- Elapsed time: 0.140607 -->"),
        (b"<p>x</p><!-- cached or not being index.aspx page --><!-- Elapsed time: 0 -->", b"<p>x</p><!-- Elapsed time: 0 -->"),
        (b"<p>x</p><!-- Elapsed time: 0 -->", b"<p>x</p><!-- cached or not being index.aspx page --><!-- Elapsed time: 0.4 -->"),
    ],
)
def test_render_comments_are_no_change(empty, capture, first, second):
    rows = decide(capture({"payload": first}, {"payload": second}), empty).orderBy("fetch_seq").collect()
    assert [r.object_written for r in rows] == [True, False]
    assert rows[0].file_hash == rows[1].file_hash


def test_a_b_a_writes_three_times(store, capture):
    february, january = {"payload": b"<html>feb</html>"}, {"payload": b"<html>jan</html>"}
    decisions = run_ingest(store, capture(february, january, february, february), AS_OF)
    rows = decisions.orderBy("fetch_seq").collect()
    assert [r.object_written for r in rows] == [True, True, True, False]
    assert [r.inserted for r in rows] == [True, False, False, False]
    objects = store.objects("landing").collect()
    assert [bytes(o.content) for o in objects] == [b"<html>feb</html>"]  # the last write is what stays
    stored_equal = run_ingest(store, capture(february, january), AS_OF).orderBy("fetch_seq").collect()
    assert [r.object_written for r in stored_equal] == [False, True]


def test_type_change_moves_the_object(store, capture):
    run_ingest(store, capture({"payload": b"<html>x</html>"}), AS_OF)
    run_ingest(store, capture({"payload": b"%PDF-1.4"}), AS_OF)
    row = store.read("landing").head()
    assert (row.file_path, row.document_type) == ("Tribunal/T-1.pdf", "pdf")


def brute_force_decisions(rows, stored):
    """One write after the other, the way a single-threaded ingestor would do it."""
    current, out = dict(stored), {}
    for key, seq, path, digest in sorted(rows, key=lambda r: r[1]):
        out[seq] = (current.get(key) != (path, digest), key not in current)
        current[key] = (path, digest)
    return out


@pytest.mark.parametrize(("parts", "bound"), [(1, 100), (2, 100), (5, 30), (40, 100), (5, 10**6), (5, 0)])
def test_write_decisions_equal_sequential_writes_whatever_the_lanes(spark, parts, bound):
    """One identity holds most rows, so its history spans many lanes."""
    rng = random.Random(parts)
    rows, stored = [], {("B", "hot"): ("p", "a"), ("B", "k1"): ("p", None)}
    for seq in rng.sample(range(1000), 300):
        key = ("B", "hot" if rng.random() < 0.7 else f"k{rng.randrange(6)}")
        rows.append((key, seq, rng.choice("pq"), rng.choice(["a", "b", None])))
    frame = spark.createDataFrame([(*k, s, p, h) for k, s, p, h in rows], "body string, identifier string, fetch_seq long, file_path string, file_hash string")
    before = spark.createDataFrame([(*k, *v) for k, v in stored.items()], "body string, identifier string, file_path string, file_hash string")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = write_decisions(frame, before, bound=bound).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert {r.fetch_seq: (r.object_written, r.inserted) for r in got} == brute_force_decisions(rows, stored)


def test_no_window_group_holds_a_whole_heavy_identity(spark):
    """A third of the rows is one identity, and its numbers are as sparse and uneven as can be."""
    rows = spark.range(30000).selectExpr(
        "'B' body", "if(id % 3 = 0, 'hot', concat('k', id)) identifier", "id * id * 1000003 fetch_seq", "id % 3 file_hash"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = lanes(rows).groupBy("body", "identifier", "_lane").count().agg(F.max("count")).head()[0]
    assert sizes <= 1.5 * 30000 / parts


def test_bad_numbers_and_missing_payloads_are_failures(store, capture):
    """Every capture has its row, and none gets the bytes of another."""
    rows = capture(
        {"identifier": "N", "fetch_seq": -3},
        {"identifier": "P", "payload": None, "fetch_seq": 1},
        {"identifier": "A", "payload": b"<p>a</p>", "fetch_seq": 2},
        {"identifier": "B", "payload": b"<p>b</p>", "fetch_seq": 2},
        {"identifier": "T", "payload": b"<p>1</p>", "fetch_seq": 3},
        {"identifier": "T", "payload": b"<p>2</p>", "fetch_seq": 3},
        {"identifier": "T", "payload": b"<p>3</p>", "fetch_seq": 4},
        {"identifier": "A", "status": 500, "payload": b"oops", "fetch_seq": 2},
        {"identifier": "S", "status": None, "error_code": None, "reason": None, "fetch_seq": 9},
        {"identifier": "X", "body": None, "fetch_seq": 10},
    )
    decisions = run_ingest(store, rows, AS_OF)
    total = run_summary(scope_stats(decisions)).head()
    assert (total.records_found, total.records_scraped, total.failed) == (10, 3, 7)
    failed = sorted((r.identifier, r.error_code, r.reason) for r in failures(decisions).collect())
    prefix = "landing write failed: "
    assert failed == [
        ("A", "500", "http error 500"),
        ("N", "ValidationError", prefix + "fetch_seq is missing or negative"),
        ("P", "ValidationError", prefix + "a fetched capture without payload"),
        ("S", "no_answer", "neither status nor error"),
        ("T", "ValidationError", prefix + "fetch_seq occurs twice for the identity"),
        ("T", "ValidationError", prefix + "fetch_seq occurs twice for the identity"),
        ("X", "ValidationError", prefix + "missing body"),
    ]
    content = {o.file_path: bytes(o.content) for o in store.objects("landing").collect()}
    assert content == {"Tribunal/A.html": b"<p>a</p>", "Tribunal/B.html": b"<p>b</p>", "Tribunal/T.html": b"<p>3</p>"}


def test_latest_per_identity_combines_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("'B' body", "'hot' identifier", "id fetch_seq", "id * 2 value")
    latest = latest_per_identity(rows)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert latest.head().value == 1998


def test_upsert_absent_keeps_and_null_overwrites(spark):
    stored = spark.createDataFrame([("B", "1", "old", "e1", "x"), ("B", "2", "old", "e2", "y")], "body string, identifier string, title string, http_etag string, extra string")
    batch = spark.createDataFrame([("B", "1", 5, "new", None), ("B", "1", 4, "older", "e9"), ("B", "3", 6, "add", "e3")], "body string, identifier string, fetch_seq int, title string, http_etag string")
    rows = {r.identifier: r for r in upsert(stored, batch).collect()}
    assert (rows["1"].title, rows["1"].http_etag, rows["1"].extra, rows["1"].action) == ("new", None, "x", "updated")
    assert (rows["2"].title, rows["2"].http_etag, rows["2"].action) == ("old", "e2", "kept")
    assert (rows["3"].title, rows["3"].extra, rows["3"].action) == ("add", None, "inserted")
    assert merge(stored, stored).count() == 2


def test_a_record_can_move_to_another_partition(store, capture):
    run_ingest(store, capture({}, {"identifier": "T-2"}), AS_OF)
    moved = {"partition_date": "2024-01-15", "partition": "2024-01-15/2024-02-01"}
    run_ingest(store, capture({**moved}), AS_OF)
    rows = {r.identifier: r for r in store.read("landing").collect()}
    assert rows["T-1"].partition_date == "2024-01-15"
    assert rows["T-1"].object_partition == "2024-01-01"  # the object was not written again
    assert rows["T-2"].partition_date == "2024-01-01"
    run_ingest(store, capture({**moved, "identifier": "T-2"}), AS_OF)
    assert set(store.state()[1]["landing"]) == {"2024-01-15"}  # an emptied partition is gone


def test_landing_after_and_objects_are_lazy_frames_too(empty, capture):
    rows = ten(capture)
    decisions = decide(rows, empty)
    assert landing_after(empty, decisions, AS_OF).count() == 10
    objects = objects_to_write(rows, last_writes(decisions)).collect()
    assert {o.content_type for o in objects} == {"text/html; charset=utf-8"}


def test_triage(spark):
    statuses = [200, 204, 299, 300, 304, 404, 503, None]
    frame = spark.createDataFrame([(s, None, None) for s in statuses], "status int, error_code string, reason string")
    got = [r.outcome for r in triage(frame).collect()]
    assert got == ["fetched"] * 3 + ["failed", "unchanged"] + ["failed"] * 3


def test_validation_accepts_empty_strings(capture):
    assert with_validation(capture({"title": "", "description": ""})).head().error_code is None


@pytest.mark.parametrize("day", ["", "2024/01/01", "January", "2024-01-01 "])
def test_a_partition_date_that_cannot_name_a_folder_is_a_failure(store, capture, day):
    decisions = run_ingest(store, capture({"partition_date": day}, {"identifier": "T-2"}), AS_OF)
    failed = decisions.where("outcome = 'failed'").head()
    assert (failed.error_code, failed.reason) == ("ValidationError", "landing write failed: partition_date is no ISO date")
    assert [r.identifier for r in store.read("landing").collect()] == ["T-2"]


def test_document_plan_sends_stored_validators(spark, capture, empty):
    names = METADATA["landing"].names
    known = {**dict.fromkeys(names, "x"), "body": "Tribunal", "identifier": "T-1", "http_etag": 'W/"v1"', "http_last_modified": None}
    stored = spark.createDataFrame([tuple(known[n] for n in names)], METADATA["landing"])
    cards = capture({"title": ""}, {"identifier": "T-2", "document_url": "u"}, {"identifier": ""}).select(
        "body", "identifier", "title", "document_url", F.lit("").alias("url")
    )
    plan = {r.identifier: r for r in document_plan(cards, stored).collect()}
    assert set(plan) == {"T-1", "T-2"}
    assert plan["T-1"].headers == {"If-None-Match": 'W/"v1"'} and plan["T-1"].title == "T-1"
    assert plan["T-2"].headers == {}


def test_requests_are_sent_once_and_on_site(spark):
    urls = ["https://example.test/a", "https://example.test/a", "https://other.test/b", "https://www.example.test/a"]
    frame = spark.createDataFrame(list(enumerate(urls)), "position int, document_url string")
    got = [r.suppressed for r in suppress_requests(frame, "position").orderBy("position").collect()]
    assert got == [None, "duplicate", "offsite", None]


def test_retries_and_rate_limits(spark):
    attempts = [("a", 503), ("a", 429), ("b", 503), ("b", 200), ("c", 404), *[("d", 500)] * 4, ("e", None)]
    frame = spark.createDataFrame([(i, u, s, "30" if s == 429 else "") for i, (u, s) in enumerate(attempts)], "fetch_seq long, document_url string, status int, retry_after string")
    assert sorted((r.document_url, r.attempts) for r in retry_worklist(frame).collect()) == [("a", 2), ("e", 1)]
    limited = rate_limited(frame).orderBy("fetch_seq").collect()
    assert [(r.error_code, r.retry_after, r.is_final) for r in limited] == [
        ("503", None, False), ("429", "30", True), ("503", None, False),
    ]
