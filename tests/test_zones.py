from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from doclake.operators.stats import run_summary, scope_stats
from doclake.plans import audit, ingest
from doclake.plans.ingest import decide, last_writes, objects_to_write, run_ingest
from doclake.plans.transform import (
    key_collisions,
    locate_indexed,
    run_transform,
    transform,
    transform_events,
    transform_located,
)
from doclake.plans.window import run_window
from doclake.sources import index
from doclake.sources import objects as object_table
from doclake.sources.index import LANDING_OBJECT
from doclake.sources.store import Conflict, Store

AS_OF = "2024-06-01T00:00:00+00:00"
HTML = b"<html><title>T</title><body><nav>menu</nav><main>Text</main></body></html>"
PDF = b"%PDF-1.4\n1 0 obj\n<< /Type /Catalog >>\nendobj\n%%EOF\n"
DOC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1legacy word payload"
DOCX = b"PK\x03\x04zip payload"
YEAR = ("2024-01-01", "2025-01-01")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "zones"))


def documents(capture, *extra):
    return capture(
        {"identifier": "H 1", "payload": HTML},
        {"identifier": "P/1", "payload": PDF},
        {"identifier": "D-1", "payload": DOC, "content_type": None},
        {"identifier": "X-1", "payload": DOCX, "content_type": None},
        *extra,
    )


def test_binaries_pass_and_pages_are_cleaned(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    outcomes = run_transform(store, *YEAR, AS_OF)
    assert outcomes.where("error_code is not null").count() == 0
    content = {o.file_path: bytes(o.content) for o in store.objects("transformed").collect()}
    assert content["P-1.pdf"] == PDF and content["D-1.doc"] == DOC and content["X-1.docx"] == DOCX
    assert b"<main>Text</main>" in content["H_1.html"] and b"menu" not in content["H_1.html"]
    rows = {r.identifier: r for r in store.read("transformed").collect()}
    assert rows["H 1"].source_file_path == "Tribunal/H_1.html"
    assert rows["H 1"].title == "T-1" and rows["H 1"].transformed_at == AS_OF
    landing = {r.identifier: r for r in store.read("landing").collect()}
    assert rows["P/1"].file_hash == landing["P/1"].file_hash
    assert rows["H 1"].file_hash != landing["H 1"].file_hash


def test_range_is_half_open(store, capture):
    dates = ["2023-12-01", "2024-01-01", "2024-02-01", "2024-03-01"]
    run_ingest(store, capture(*[{"identifier": d, "partition_date": d, "payload": PDF} for d in dates]), AS_OF)
    run_transform(store, "2024-01-01", "2024-03-01", AS_OF)
    assert sorted(r.identifier for r in store.read("transformed").collect()) == dates[1:3]
    assert store.read("landing", "2024-01-01", "2024-03-01").count() == 2


def test_one_bad_document_does_not_stop_the_others(store, capture):
    run_ingest(store, documents(capture, {"identifier": "N-1", "payload": b"<nav>menu</nav>"}), AS_OF)
    outcomes = run_transform(store, *YEAR, AS_OF)
    bad = outcomes.where("error_code is not null").collect()
    assert [(r.identifier, r.error_code) for r in bad] == [("N-1", "ContentNotFound")]
    total = run_summary(scope_stats(transform_events(outcomes))).head()
    assert (total.records_found, total.records_scraped, total.failed) == (5, 4, 1)
    assert store.read("transformed").count() == store.objects("transformed").count() == 4


def test_lost_objects_and_incomplete_records_are_failures(spark, store, capture):
    run_ingest(store, documents(capture), AS_OF)
    landing = store.read("landing").drop("object_partition")
    landing = landing.withColumn("file_path", F.when(F.col("identifier") == "D-1", "").otherwise(F.col("file_path")))
    objects = store.objects("landing").where("file_path not like '%.pdf'")
    rows = {r.identifier: r.error_code for r in transform(landing, objects, AS_OF).collect()}
    assert rows == {"H 1": None, "X-1": None, "P/1": "NoSuchKey", "D-1": "ValueError"}


def test_landing_stays_as_it_was(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    before = object_table.snapshot(store.objects("landing")).collect()
    rows = sorted(store.read("landing").collect())
    run_transform(store, *YEAR, AS_OF)
    assert sorted(object_table.snapshot(store.objects("landing")).collect()) == sorted(before)
    assert sorted(store.read("landing").collect()) == rows


def test_second_transform_updates_in_place(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    run_transform(store, *YEAR, "first")
    run_transform(store, *YEAR, "second")
    rows = store.read("transformed").collect()
    assert len(rows) == 4 and {r.transformed_at for r in rows} == {"second"}
    current = object_table.current_objects(store.objects("transformed"))
    assert current.count() == 4 and store.objects("transformed").count() == 8


def test_transform_finds_an_object_that_stayed_in_an_older_partition(store, capture):
    run_ingest(store, capture({"payload": PDF}), AS_OF)
    run_ingest(store, capture({"payload": PDF, "partition_date": "2024-05-01"}), AS_OF)
    outcomes = run_transform(store, "2024-05-01", "2024-06-01", AS_OF)
    assert [r.error_code for r in outcomes.collect()] == [None]


def test_bodies_sharing_an_identifier_collide_on_one_object(store, capture):
    rows = [{"body": b, "identifier": "S-1", "payload": PDF + b.encode()} for b in ("A", "C", "B")]
    run_ingest(store, capture(*rows), AS_OF)
    run_transform(store, *YEAR, AS_OF)
    assert store.read("transformed").count() == 3
    current = object_table.current_objects(store.objects("transformed")).collect()
    assert [bytes(o.content) for o in current] == [PDF + b"C"]
    report = key_collisions(store.read("transformed")).collect()
    assert [(r.file_path, r.bodies, r.winner_body) for r in report] == [("S-1.pdf", 3, "C")]


def test_audits_of_clean_zones_find_nothing(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    snapshot = object_table.snapshot(store.objects("landing"))
    run_transform(store, *YEAR, AS_OF)
    landing = audit.audit_landing(store.read("landing"), store.objects("landing")).head()
    assert landing.landing_documents == 4 and not landing.bad
    zones = audit.audit_transformed(
        store.read("transformed"), store.objects("transformed"), store.read("landing"), store.objects("landing"), snapshot
    ).head()
    assert (zones.transformed_documents, zones.landing_documents, zones.bad) == (4, 4, False)


def test_audit_of_nothing_is_one_row_of_zeros(store):
    row = audit.audit_landing(store.read("landing"), store.objects("landing")).head()
    assert row.landing_documents == 0 and row.duplicate_identities == 0 and not row.bad


def test_audit_counts_damage(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    records = store.read("landing").withColumn("description", F.when(F.col("identifier") != "D-1", "d").otherwise(""))
    records = records.unionByName(records.where("identifier = 'X-1'"))
    objects = store.objects("landing").withColumn("content", F.concat("content", F.lit(b"!")))
    row = audit.audit_landing(records, objects.where("file_path not like '%.pdf'")).head()
    assert (row.duplicate_identities, row.missing_objects, row.hash_mismatches, row.metadata_gaps, row.bad) == (1, 1, 4, 1, True)


def test_export_and_read_back(spark, store, capture, tmp_path):
    run_ingest(store, documents(capture), AS_OF)
    root = f"file://{tmp_path}/out"
    files, size = object_table.export_objects(store.objects("landing"), root)
    back = {r.file_path: bytes(r.content) for r in object_table.read_exported(spark, root).collect()}
    assert back["Tribunal/P-1.pdf"] == PDF and files == len(back) == 4
    assert size == sum(map(len, back.values()))


def test_a_run_that_dies_leaves_nothing_visible(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    seen = sorted(store.read("landing").collect())
    dying = store.begin()
    dying.write_objects(
        "landing",
        capture({"identifier": "Z"}).select(
            F.lit("Z/Z.html").alias("file_path"), F.col("payload").alias("content"), "content_type",
            F.lit("h").alias("file_hash"), "fetch_seq", "partition_date",
        ),
    )
    assert sorted(store.read("landing").collect()) == seen and store.objects("landing").count() == 4
    run_ingest(store, capture({"identifier": "Q", "partition_date": "2024-09-01"}), AS_OF)
    assert {o.file_path for o in store.objects("landing").collect()} >= {"Tribunal/Q.html"}
    assert store.objects("landing").where("file_path = 'Z/Z.html'").count() == 0


def test_a_dead_ingest_is_not_committed_by_the_next_transform(store, capture):
    """The transform takes the same run number; the dead attempt's bytes stay out of it."""
    run_ingest(store, documents(capture), AS_OF)
    dying = store.begin()
    dying.write_objects(
        "landing",
        capture({"payload": b"<main>dead</main>"}).select(
            F.lit("Tribunal/H_1.html").alias("file_path"), F.col("payload").alias("content"), "content_type",
            F.lit("h").alias("file_hash"), F.lit(10**6).alias("fetch_seq"), "partition_date",
        ),
    )
    run_transform(store, *YEAR, AS_OF)
    assert store.state()[0] == dying.number
    landing = audit.audit_landing(store.read("landing"), store.objects("landing")).head()
    assert (landing.hash_mismatches, landing.bad) == (0, False)
    content = {o.file_path: bytes(o.content) for o in store.objects("transformed").collect()}
    assert b"dead" not in content["H_1.html"]


def test_null_content_is_a_failure(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    objects = store.objects("landing").withColumn("content", F.when(F.col("file_path") != "Tribunal/D-1.doc", F.col("content")))
    landing = store.read("landing").drop("object_partition")
    rows = {r.identifier: r.error_code for r in transform(landing, objects, AS_OF).collect()}
    assert rows == {"H 1": None, "X-1": None, "P/1": None, "D-1": "NoContent"}


def test_checks_of_presence_read_no_content(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    run_transform(store, *YEAR, AS_OF)
    landing = audit.landing_checks(store.read("landing"), store.objects("landing"))
    transformed = audit.transformed_checks(store.read("transformed"), store.objects("transformed"))
    for rows, flags in ((landing, ["missing_object", "bad_key"]), (transformed, ["missing_object", "name_mismatch"])):
        for flag in flags:
            plan = rows.where(flag).select("file_path")._jdf.queryExecution().executedPlan().toString()
            assert "sha2" not in plan and "content#" not in plan
    assert landing.where("missing_object or bad_key or hash_mismatch").count() == 0


def test_back_fill_is_one_wide_window(store, capture):
    dates = ["2024-01-01", "2024-02-01", "2024-03-01"]
    rows = capture(*[{"identifier": d, "partition_date": d, "payload": HTML} for d in dates])
    result = run_window(store, rows, "2024-01-01", "2024-03-01", AS_OF)
    assert result.ingest_summary().head().records_found == 2
    summary = result.transform_summary().head()
    assert (summary.records_scraped, summary.run_failed) == (2, False)
    with pytest.raises(ValueError):
        run_window(store, rows, "2024-03-01", "2024-03-01", AS_OF)


def test_range_scan_lists_only_its_folders(store, capture):
    dates = [f"2024-{m:02}-01" for m in range(1, 13)]
    run_ingest(store, capture(*[{"identifier": d, "partition_date": d} for d in dates]), AS_OF)
    files = store.read("landing", "2024-03-01", "2024-05-01").inputFiles()
    assert files and all("2024-03-01" in f or "2024-04-01" in f for f in files)


def located_in(store, start, end):
    """What a transform settles before it reads content, and the objects it reads."""
    run = store.begin()
    landing = store.read("landing", start, end).drop("object_partition")
    located = run.stage("located", locate_indexed(landing, run.find(LANDING_OBJECT, landing)))
    places = [tuple(p) for p in located.select("object_folder", "object_partition").distinct().collect()]
    return located.drop("object_folder", "object_partition"), store.objects_at(places, run.buckets)


def exchanges(frame):
    """The exchanges of a plan, each with the columns it carries."""
    lines = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines()
    return [lines[at + 1] for at, line in enumerate(lines) if re.match(r"\(\d+\) Exchange", line)]


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, usual)


def test_transform_scans_content_once_in_its_partitions(store, capture):
    dates = ["2024-01-01", "2024-02-01", "2024-03-01"]
    run_ingest(store, capture(*[{"identifier": d, "partition_date": d, "payload": HTML} for d in dates]), AS_OF)
    located, objects = located_in(store, "2024-02-01", "2024-03-01")
    plan = transform_located(located, objects, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "content#" in line]
    assert len(scans) == 1 and "(partition_date" in scans[0].split("PartitionFilters")[1]
    assert plan.count("ArrowEvalPython") == 1
    assert all("2024-02-01" in f for f in objects.inputFiles())


def test_no_exchange_carries_content_in_a_transform(store, capture, no_broadcast):
    """Neither where the slim side is too large to broadcast, nor over objects of several runs."""
    for month in ("2024-01-01", "2024-02-01"):
        run_ingest(store, capture(*[{"identifier": f"{month} {i}", "partition_date": month, "payload": HTML} for i in range(9)]), AS_OF)
    located, objects = located_in(store, *YEAR)
    rows = transform_located(located, objects, AS_OF)
    moved = exchanges(rows)
    assert moved and not any("content" in columns for columns in moved)
    assert rows.where("error_code is null").count() == 18


def test_one_exchange_carries_the_payload_of_an_ingest(store, capture, no_broadcast):
    rows = documents(capture)
    decisions = store.begin().stage("decisions", decide(rows, store.read("landing")))
    # Many: dealt to the buckets before the join, and written as they lie.
    moved = exchanges(objects_to_write(rows, last_writes(decisions), buckets=3))
    assert sum("payload" in columns or "content" in columns for columns in moved) == 1
    few = objects_to_write(rows, F.broadcast(last_writes(decisions))).repartition(3, "file_path")
    assert sum("payload" in columns or "content" in columns for columns in exchanges(few)) == 1


def test_many_and_few_objects_are_written_alike(spark, tmp_path, capture, monkeypatch):
    rows = documents(capture, {"identifier": "X/1", "payload": PDF}, {"identifier": "P-1", "payload": PDF + b"2"}, {"identifier": "gone", "status": 404})
    content = []
    for few in (100, 0):
        monkeypatch.setattr(ingest, "FEW", few)
        store = Store(spark, str(tmp_path / str(few)), buckets=3)
        run_ingest(store, rows, AS_OF)
        content.append(sorted((o.file_path, bytes(o.content), o.fetch_seq) for o in store.objects("landing").collect()))
    assert content[0] == content[1] and len(content[0]) == 5


def test_a_key_written_last_in_another_partition(store, capture):
    """A narrow range gives a record what the wide one gives it."""
    january, march = {"partition_date": "2024-01-01"}, {"partition_date": "2024-03-01"}
    run_ingest(store, capture({"identifier": "X/1", "payload": PDF + b"1", **january}, {"identifier": "X-1", "payload": PDF + b"2", **march}), AS_OF)
    run_ingest(store, capture({"identifier": "Y/1", "payload": PDF + b"3", **january}), AS_OF)
    run_ingest(store, capture({"identifier": "Y-1", "payload": PDF + b"4", **march}), AS_OF)
    columns = ["identifier", "file_path", "file_hash", "error_code"]
    wide = run_transform(store, *YEAR, AS_OF).where("partition_date < '2024-02-01'").select(*columns)
    narrow = run_transform(store, "2024-01-01", "2024-02-01", AS_OF).select(*columns)
    assert sorted(narrow.collect()) == sorted(wide.collect()) and narrow.count() == 2
    assert narrow.where("error_code is not null").count() == 0


def test_a_lookup_opens_the_touched_buckets_only(spark, tmp_path, capture):
    store = Store(spark, str(tmp_path / "zones"), buckets=32)
    run_ingest(store, capture(*[{"identifier": f"T-{i}"} for i in range(200)]), AS_OF)
    run_ingest(store, capture({"identifier": "T-7", "payload": PDF}), AS_OF)
    run, batch = store.begin(), capture({"identifier": "T-7"}, {"identifier": "new"})
    parts = store.state()[1]["landing_identity"]
    hit = index.touched(index.LANDING_IDENTITY, batch, run.buckets)
    assert run.buckets == 32 and len(hit) <= 2
    opened = index.read(spark, store.root, index.LANDING_IDENTITY, parts, hit).inputFiles()
    assert opened and {int(re.search(r"bucket=(\d+)", f)[1]) for f in opened} <= hit
    found = run.find(index.LANDING_IDENTITY, batch).collect()
    assert [(r.identifier, r.file_path) for r in found] == [("T-7", "Tribunal/T-7.pdf")]


def test_the_index_is_what_the_zone_holds(spark, tmp_path, capture, monkeypatch):
    monkeypatch.setattr(index, "MOST_FOLDERS", 3)
    store = Store(spark, str(tmp_path / "zones"), buckets=4)
    for turn in range(6):
        rows = [{"identifier": f"T-{i}", "payload": f"<main>{turn * (i % 3)}</main>".encode()} for i in range(turn, turn + 6)]
        run_ingest(store, capture(*rows), AS_OF)
    landing = store.read("landing")
    names = index.LANDING_IDENTITY.schema.names
    known = store.begin().find(index.LANDING_IDENTITY, landing)
    assert sorted(known.select(*names).collect()) == sorted(landing.select(*names).collect())
    assert max(map(len, index.folders(store.state()[1]["landing_identity"]).values())) <= 3
    pointed = store.begin().find(LANDING_OBJECT, landing.select("file_path"))
    current = object_table.current_versions(store.objects("landing"))
    assert sorted((r.file_path, r.object_run, r.fetch_seq) for r in pointed.collect()) == sorted((r.file_path, *r.write_order) for r in current.collect())


def test_a_store_from_before_the_indexes_is_indexed_once(store, capture):
    run_ingest(store, documents(capture), AS_OF)
    old = store.begin()
    old.zones = {z: parts for z, parts in old.zones.items() if z in ("landing", "landing_objects", "layout")}
    old.commit()
    second = run_ingest(store, documents(capture), AS_OF)
    assert second.where("object_written or inserted").count() == 0
    assert run_transform(store, *YEAR, AS_OF).where("error_code is not null").count() == 0


def test_of_two_runs_from_one_state_one_is_done_again(store, capture):
    """The second writer commits while the first is at work: the first decides again against it."""
    run_ingest(store, capture({"identifier": "old"}), AS_OF)
    begin, meddled = store.begin, []

    def begin_and_be_overtaken():
        run = begin()
        if not meddled:
            meddled.append(True)
            run_ingest(Store(store.spark, store.root), capture({"identifier": "T-1"}, {"identifier": "T-2"}), "other")
        return run

    store.begin = begin_and_be_overtaken
    decisions = run_ingest(store, capture({"identifier": "T-1"}, {"identifier": "T-3"}), "own").collect()
    # T-1 is known by now, and its bytes are there.
    assert {r.identifier: (r.inserted, r.object_written) for r in decisions} == {"T-1": (False, False), "T-3": (True, True)}
    landing = store.read("landing")
    assert {r.identifier: r.scraped_at for r in landing.collect()} == {"old": AS_OF, "T-1": "own", "T-2": "other", "T-3": "own"}
    assert landing.count() == 4 and store.state()[0] == 3
    assert run_transform(store, *YEAR, AS_OF).count() == 4


def test_a_run_that_is_always_overtaken_gives_up(store, capture):
    begin, other = store.begin, Store(store.spark, store.root)

    def overtaken():
        run = begin()
        other.begin().commit()
        return run

    store.begin = overtaken
    with pytest.raises(Conflict):
        run_ingest(store, capture({}), AS_OF)
    assert other.read("landing").count() == 0
