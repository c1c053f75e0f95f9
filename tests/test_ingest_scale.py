from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from doclake.functions import text
from doclake.plans import ingest
from doclake.session import compiled
from doclake.sources.objects import export_objects, read_exported
from doclake.sources.store import Run, Store

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_the_method_limit_holds_inside_the_block_only(spark):
    usual = spark.conf.get(LIMIT)
    with pytest.raises(ValueError), compiled(spark):
        assert spark.conf.get(LIMIT) == "8000"
        raise ValueError
    assert spark.conf.get(LIMIT) == usual != "8000"


def test_an_ingest_runs_compiled_and_looks_its_identities_up_in_slim_rows(spark, capture, tmp_path, monkeypatch):
    """The second batch finds what the first stored without another scan of the captures."""
    wanted, limits, usual = [], [], spark.conf.get(LIMIT)
    find, stage = Run.find, Run.stage

    def seen_find(run, index, rows):
        wanted.append(rows.columns)
        return find(run, index, rows)

    def seen_stage(run, name, rows):
        limits.append(spark.conf.get(LIMIT))
        return stage(run, name, rows)

    monkeypatch.setattr(Run, "find", seen_find)
    monkeypatch.setattr(Run, "stage", seen_stage)
    store = Store(spark, str(tmp_path))
    ingest.run_ingest(store, capture({"identifier": "A"}, {"identifier": None}), "2024-02-01")
    second = capture({"identifier": "A", "fetch_seq": 7}, {"identifier": "B", "fetch_seq": 8})
    rows = ingest.run_ingest(store, second, "2024-02-01").collect()
    assert {r.identifier: (r.inserted, r.object_written) for r in rows} == {"A": (False, False), "B": (True, True)}
    assert len(wanted) == 2 and all("payload" not in columns for columns in wanted)
    assert set(limits) == {"8000"} and spark.conf.get(LIMIT) == usual


def test_invalid_records_have_a_reason_and_only_they(spark, capture):
    rows = capture({}, {"identifier": "//"}, {"title": None}, {"partition_date": "x"}, {"payload": None}, {"fetch_seq": -1}, {"identifier": None})
    found = ingest.with_validation(rows).select("error_code", "reason").collect()
    assert [r.error_code for r in found] == [None, "ValueError", *["ValidationError"] * 5]
    assert found[0].reason is None and all(r.reason.startswith("landing write failed: ") for r in found[1:])


def test_strip_takes_every_kind_of_white_space_and_no_other(column):
    characters = [chr(c) for c in range(1, 0x3100)]
    white = [c for c in characters if re.match(f"[{text.WHITESPACE}]", c)]
    assert column(text.strip(F.col("v")), [f"{c}a{c}b{c}{c}" for c in characters]) == [f"a{c}b" if c in white else f"{c}a{c}b{c}{c}" for c in characters]
    assert column(text.strip(F.col("v")), ["".join(white), "", None]) == ["", "", None]


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    """By its cost for an opened file Spark would make a task of every 32 files."""
    objects = spark.range(200).select(F.concat(F.lit("src/"), "id").alias("file_path"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    export_objects(objects, str(tmp_path / "files"))
    files = read_exported(spark, str(tmp_path / "files"))
    assert files.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(r.file_path, bytes(r.content)) for r in files.collect()} == {(f"src/{i}", str(i).encode()) for i in range(200)}
