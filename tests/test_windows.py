from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from doclake.functions import windows
from doclake.operators import frontier


def _windows(spark, start, end, size="monthly"):
    array = windows.window_array(F.lit(date.fromisoformat(start)), F.lit(date.fromisoformat(end)), size)
    rows = spark.range(1).select(F.explode(array).alias("w")).collect()
    return [(str(r.w.start), str(r.w.end)) for r in rows]


def test_half_open_months(spark):
    assert _windows(spark, "2024-01-01", "2024-04-01") == [
        ("2024-01-01", "2024-02-01"),
        ("2024-02-01", "2024-03-01"),
        ("2024-03-01", "2024-04-01"),
    ]


def test_months_are_clipped_at_both_ends(spark):
    assert _windows(spark, "2024-01-15", "2024-03-10") == [
        ("2024-01-15", "2024-02-01"),
        ("2024-02-01", "2024-03-01"),
        ("2024-03-01", "2024-03-10"),
    ]


def test_weeks_step_from_the_start(spark):
    assert _windows(spark, "2024-01-01", "2024-01-15", "weekly") == [
        ("2024-01-01", "2024-01-08"),
        ("2024-01-08", "2024-01-15"),
    ]
    assert _windows(spark, "2024-01-03", "2024-01-12", "weekly")[-1] == ("2024-01-10", "2024-01-12")


@pytest.mark.parametrize("size", windows.SIZES)
def test_empty_and_reversed_ranges_have_no_windows(spark, size):
    assert _windows(spark, "2024-01-15", "2024-01-15", size) == []
    assert _windows(spark, "2024-02-15", "2024-01-15", size) == []


@pytest.mark.parametrize("size", windows.SIZES)
def test_every_day_is_assigned_to_the_window_that_holds_it(spark, size):
    start, end = date(2023, 11, 17), date(2024, 3, 9)
    listed = _windows(spark, str(start), str(end), size)
    days = [(start + timedelta(days=i),) for i in range(-3, 120)]
    frame = spark.createDataFrame(days, "day date")
    placed = windows.with_window(frame, F.col("day"), start, end, size).collect()
    assert len(placed) == (end - start).days
    for row in placed:
        inside = [w for w in listed if w[0] <= str(row.day) < w[1]]
        assert row.partition == "/".join(inside[0])
        assert row.partition_date == inside[0][0]


def test_bad_arguments_fail_before_any_job():
    with pytest.raises(ValueError, match="unsupported partition size"):
        windows.check_size("daily")
    for start, end in (("01-01-2024", "2024-02-01"), (None, "2024-02-01"), ("2024-02-01", "2024-02-01")):
        with pytest.raises(ValueError):
            windows.check_range(start, end)


def test_range_join_equals_nested_loop(spark):
    spans = [(i, date(2024, 1, 1) + timedelta(days=3 * i), date(2024, 1, 1) + timedelta(days=3 * i + i)) for i in range(9)]
    days = [(n, date(2024, 1, 1) + timedelta(days=n % 40)) for n in range(200)]
    rows = spark.createDataFrame(days, "n int, day date")
    table = spark.createDataFrame(spans, "id int, start date, end date")
    got = {(r.n, r.id) for r in windows.range_join(rows, "day", table).collect()}
    assert got == {(n, i) for n, d in days for i, a, b in spans if a <= d < b}


@pytest.mark.parametrize("bound", [1, 7, 10**6])
def test_range_join_with_open_windows_and_a_hot_day(spark, bound):
    first = date(2023, 12, 30)
    spans = [(0, first, date(9999, 12, 31)), (1, date(1, 1, 1), date(2024, 1, 5)), (2, first, first), (3, None, first), (4, date(2024, 1, 2), date(2024, 1, 3))]
    spans += [(5 + i, first + timedelta(days=i % 7), first + timedelta(days=i % 7 + i)) for i in range(25)]
    days = [(n, first + timedelta(days=2 if n % 3 == 0 else n % 31), "x") for n in range(150)] + [(999, None, "x")]
    rows = spark.createDataFrame(days, "n int, day date, id string")
    table = spark.createDataFrame(spans, "id int, start date, end date").withColumnRenamed("id", "window")
    got = sorted((r.n, r.window) for r in windows.range_join(rows, "day", table, bound).collect())
    assert got == sorted((n, i) for n, d, _ in days for i, a, b in spans if d and a and a <= d < b)


def test_a_window_is_few_nodes(spark):
    spans = [(date(2024, 1, 1), date(9999, 12, 31)), (date(1, 1, 1), date(9999, 12, 31)), (date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 1, 2), date(2024, 1, 1))]
    frame = spark.createDataFrame(spans, "start date, end date")
    for row in frame.select("start", "end", windows.dyadic_nodes(F.col("start"), F.col("end")).alias("nodes")).collect():
        days = max(0, (row.end - row.start).days)
        assert sum(1 << n.level for n in row.nodes) == days and len(row.nodes) <= 2 * max(1, days.bit_length())
        assert all((n.node << n.level) >= row.start.toordinal() - 1 and ((n.node + 1) << n.level) <= row.end.toordinal() - 1 for n in row.nodes)


def test_listing_plan(spark):
    bodies = spark.createDataFrame([("3", "High Tribunal"), ("7", "Board")], "body_id string, body string")
    rows = frontier.listing_plan(bodies, "2024-01-01", "2024-03-01").orderBy("body_id", "partition").collect()
    assert len(rows) == 4
    assert rows[0].url.endswith("?decisions=1&from=1/1/2024&to=31/1/2024&body=3&pageNumber=1")
    assert rows[0].partition_date == "2024-01-01"
    assert rows[1].partition == "2024-02-01/2024-03-01"


def test_the_grid_needs_no_join(spark):
    bodies = spark.range(5).selectExpr("cast(id as string) body_id", "'b' body")
    plan = windows.scope_grid(bodies, "2024-01-01", "2024-03-01")._jdf.queryExecution().toString()
    assert "Join" not in plan and "Cartesian" not in plan
