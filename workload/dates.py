"""Date windows, scope grids and listing plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import windows
from doclake.operators import frontier
from workload.registry import query, table

_SPANS = """
spans AS (
  SELECT o_custkey AS custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
  FROM orders GROUP BY o_custkey)
"""


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's first and last order date; a single order gives an empty range."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    )


def _exploded(spans: DataFrame, size: str) -> DataFrame:
    window = F.explode(windows.window_array(F.col("s"), F.col("e"), size)).alias("w")
    start, end = F.col("w.start"), F.col("w.end")
    return spans.select("custkey", window).select(
        "custkey",
        start.cast("string").alias("window_start"),
        end.cast("string").alias("window_end"),
        windows.partition_label(start, end).alias("partition"),
    )


@query(
    "partition_windows_monthly",
    f"""WITH {_SPANS},
months AS (
  SELECT custkey, s, e, CAST(unnest(generate_series(date_trunc('month', s), CAST(e - 1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m
  FROM spans WHERE e > s),
w AS (SELECT custkey, strftime(greatest(m, s), '%Y-%m-%d') AS a, strftime(least(CAST(m + INTERVAL 1 MONTH AS DATE), e), '%Y-%m-%d') AS b FROM months)
SELECT custkey, a AS window_start, b AS window_end, a || '/' || b AS partition FROM w""",
)
def partition_windows_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(_spans(spark, sf_dir), "monthly")


@query(
    "partition_windows_weekly",
    f"""WITH {_SPANS},
weeks AS (
  SELECT custkey, s, e, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e - 1 AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS m
  FROM spans WHERE e > s),
w AS (SELECT custkey, strftime(m, '%Y-%m-%d') AS a, strftime(least(m + 7, e), '%Y-%m-%d') AS b FROM weeks)
SELECT custkey, a AS window_start, b AS window_end, a || '/' || b AS partition FROM w""",
)
def partition_windows_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(_spans(spark, sf_dir), "weekly")


@query(
    "assign_monthly",
    """
WITH inside AS (
  SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
  WHERE o_orderdate >= DATE '1995-01-15' AND o_orderdate < DATE '2001-07-10')
SELECT o_orderkey, strftime(greatest(m, DATE '1995-01-15'), '%Y-%m-%d') AS partition_date,
  strftime(greatest(m, DATE '1995-01-15'), '%Y-%m-%d') || '/' ||
  strftime(least(CAST(m + INTERVAL 1 MONTH AS DATE), DATE '2001-07-10'), '%Y-%m-%d') AS partition
FROM inside""",
)
def assign_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    placed = windows.with_window(rows, day, "1995-01-15", "2001-07-10", "monthly")
    return placed.drop("o_orderdate")


@query(
    "assign_weekly",
    """
WITH w AS (
  SELECT event_id, DATE '2024-01-03' + 7 * CAST(floor(date_diff('day', DATE '2024-01-03', CAST(ts AS DATE)) / 7) AS INTEGER) AS a
  FROM events WHERE ts >= DATE '2024-01-03' AND ts < DATE '2024-01-29')
SELECT event_id, strftime(a, '%Y-%m-%d') AS partition_date,
  strftime(a, '%Y-%m-%d') || '/' || strftime(least(a + 7, DATE '2024-01-29'), '%Y-%m-%d') AS partition FROM w""",
)
def assign_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    placed = windows.with_window(rows, F.to_date("ts"), "2024-01-03", "2024-01-29", "weekly")
    return placed.drop("ts")


@query(
    "range_join_windows",
    """
WITH spans AS (
  SELECT s_suppkey, DATE '1995-01-01' + CAST(s_suppkey * 7 % 2000 AS INTEGER) AS a,
    DATE '1995-01-01' + CAST(s_suppkey * 7 % 2000 + 10 + s_nationkey AS INTEGER) AS b FROM supplier)
SELECT s_suppkey, count(*) AS orders, min(o_orderkey) AS first_order, max(o_orderkey) AS last_order
FROM spans JOIN orders ON o_orderdate >= a AND o_orderdate < b GROUP BY s_suppkey""",
)
def range_join_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted in overlapping windows, one window per supplier.

    Orders are summed up per day first, so a day with a third of all orders joins as one row.
    """
    first = F.lit("1995-01-01").cast("date")
    offset = (F.col("s_suppkey") * 7 % 2000).cast("int")
    spans = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.date_add(first, offset).alias("start"),
        F.date_add(first, offset + 10 + F.col("s_nationkey")).alias("end"),
    )
    per_day = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")
    )
    joined = windows.range_join(per_day, "day", spans)
    return joined.groupBy("s_suppkey").agg(
        F.sum("n").alias("orders"), F.min("lo").alias("first_order"), F.max("hi").alias("last_order")
    )


_OPEN = """
WITH dated AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN DATE '1996-02-29' ELSE CAST(o_orderdate AS DATE) END AS day FROM orders),
spans AS (
  SELECT s_suppkey, DATE '1992-01-01' + CAST(s_suppkey * 37 % 2500 AS INTEGER) AS a,
    CASE WHEN s_suppkey % 4 = 0 THEN DATE '9999-12-31' WHEN s_suppkey % 4 = 1 THEN DATE '1992-01-01'
      ELSE DATE '1992-01-01' + CAST(s_suppkey * 37 % 2500 + s_nationkey * 9 AS INTEGER) END AS b FROM supplier)
SELECT s_suppkey, CAST(day = DATE '1996-02-29' AS INTEGER) AS hot, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM spans JOIN dated ON day >= a AND day < b GROUP BY ALL"""


@query("range_join_open", _OPEN)
def range_join_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order in every window of its day: windows to the end of the calendar, empty ones, and a
    day with a third of all orders.

    Orders are summed up per day first: each of the windows that lie open meets days, not orders.
    """
    first = F.lit("1992-01-01").cast("date")
    offset = (F.col("s_suppkey") * 37 % 2500).cast("int")
    turn = F.col("s_suppkey") % 4
    until = F.date_add(first, (offset + F.col("s_nationkey") * 9).cast("int"))
    end = F.when(turn == 0, F.lit("9999-12-31").cast("date")).when(turn == 1, first).otherwise(until)
    spans = table(spark, sf_dir, "supplier").select("s_suppkey", F.date_add(first, offset).alias("start"), end.alias("end"))
    leap = F.lit("1996-02-29").cast("date")
    day = F.when(F.col("o_orderkey") % 3 == 0, leap).otherwise(F.to_date("o_orderdate"))
    dated = table(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("sum"))
    joined = windows.range_join(dated, "day", spans)
    hot = (F.col("day") == leap).cast("int").alias("hot")
    return joined.groupBy("s_suppkey", hot).agg(F.sum("n").alias("orders"), F.sum("sum").alias("keys"))


_GRID = """
months AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-06-01', INTERVAL 1 MONTH)) AS DATE) AS m),
w AS (SELECT greatest(m, DATE '2024-01-15') AS a, least(CAST(m + INTERVAL 1 MONTH AS DATE), DATE '2024-06-10') AS b FROM months),
grid AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS body_id, s_name AS body, a, b,
    strftime(a, '%Y-%m-%d') AS partition_date, strftime(a, '%Y-%m-%d') || '/' || strftime(b, '%Y-%m-%d') AS partition
  FROM supplier, w)
"""


def _supplier_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("body_id"), F.col("s_name").alias("body")
    )


@query("scope_grid", f"WITH {_GRID} SELECT body_id, body, partition_date, partition FROM grid")
def scope_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = windows.scope_grid(_supplier_bodies(spark, sf_dir), "2024-01-15", "2024-06-10")
    return grid.select("body_id", "body", "partition_date", "partition")


@query(
    "listing_plan",
    f"""WITH {_GRID}
SELECT body_id, body, partition_date, partition, CAST(1 AS BIGINT) AS page,
  'https://decisions.example.test/en/search/?decisions=1&from=' || day(a) || '/' || month(a) || '/' || year(a)
  || '&to=' || day(b - 1) || '/' || month(b - 1) || '/' || year(b - 1) || '&body=' || body_id || '&pageNumber=1' AS url
FROM grid""",
)
def listing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = frontier.listing_plan(_supplier_bodies(spark, sf_dir), "2024-01-15", "2024-06-10")
    return plan.withColumn("page", F.col("page").cast("bigint"))
