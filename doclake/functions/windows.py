"""Half-open date windows, computed per row without a join."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.functions.requests import partition_label

SIZES = ("monthly", "weekly")


def check_size(size: str) -> str:
    if size not in SIZES:
        raise ValueError(f"unsupported partition size: {size}")
    return size


def check_date(name: str, value: date | str | None) -> date:
    """Accept a date or an ISO string; a missing or malformed value is an error before any job."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    try:
        return datetime.strptime(value or "", "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"{name} must be given as YYYY-MM-DD, got {value!r}") from None


def check_range(start: date | str, end: date | str) -> tuple[date, date]:
    first, last = check_date("start_date", start), check_date("end_date", end)
    if last <= first:
        raise ValueError("end_date must be after start_date")
    return first, last


def window_array(start: Column, end: Column, size: str = "monthly") -> Column:
    """array<struct<start,end>> covering [start, end); empty when end is not after start."""
    last_day = F.greatest(F.date_sub(end, 1), start)
    if check_size(size) == "weekly":
        firsts = F.sequence(start, last_day, F.expr("interval 7 days"))
        windows = F.transform(
            firsts, lambda d: F.struct(d.alias("start"), F.least(F.date_add(d, 7), end).alias("end"))
        )
    else:
        firsts = F.sequence(F.trunc(start, "MM"), last_day, F.expr("interval 1 month"))
        windows = F.transform(
            firsts,
            lambda m: F.struct(
                F.greatest(m, start).alias("start"), F.least(F.add_months(m, 1), end).alias("end")
            ),
        )
    return F.filter(windows, lambda w: w["start"] < w["end"])


def window_of(day: Column, start: Column, end: Column, size: str = "monthly") -> Column:
    """The window of [start, end) a day falls in, as struct<start,end>; null outside the range."""
    if check_size(size) == "weekly":
        offset = F.datediff(day, start)
        first = F.date_add(start, (offset - F.pmod(offset, F.lit(7))).cast("int"))
        after = F.date_add(first, 7)
    else:
        first = F.greatest(F.trunc(day, "MM"), start)
        after = F.add_months(F.trunc(day, "MM"), 1)
    window = F.struct(first.alias("start"), F.least(after, end).alias("end"))
    return F.when((day >= start) & (day < end), window)


def with_window(
    df: DataFrame, day: Column, start: date | str, end: date | str, size: str = "monthly"
) -> DataFrame:
    """Keep rows inside [start, end); add ``partition_date`` and the ``partition`` label."""
    first, last = check_range(start, end)
    inside = df.where((day >= F.lit(first)) & (day < F.lit(last)))
    window = window_of(day, F.lit(first), F.lit(last), size)
    return inside.withColumns(
        {
            "partition_date": window["start"].cast("string"),
            "partition": partition_label(window["start"], window["end"]),
        }
    )


def scope_grid(
    bodies: DataFrame, start: date | str, end: date | str, size: str = "monthly"
) -> DataFrame:
    """Every body with every window. Each body row explodes a constant array: no join, no shuffle."""
    first, last = check_date("start_date", start), check_date("end_date", end)
    windows = window_array(F.lit(first), F.lit(last), size)
    grid = bodies.withColumn("window", F.explode(windows))
    return grid.select(
        *[F.col(c) for c in bodies.columns],
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("window.start").cast("string").alias("partition_date"),
        partition_label(F.col("window.start"), F.col("window.end")).alias("partition"),
    )


# Days are counted from 0001-01-01; 2 ** 22 of them reach beyond 9999-12-31.
LEVELS = 23
# Rows of one day that one task should join.
DAY_ROWS = 1 << 20


def _number(day: Column) -> Column:
    return F.datediff(day, F.lit("0001-01-01").cast("date"))


def dyadic_nodes(start: Column, end: Column) -> Column:
    """array<struct<level,node>>: [start, end) as disjoint runs of 2^level days that begin at
    multiples of their length; two a level at most, and none for an empty window."""

    def at(level: Column) -> Column:
        # The first whole node inside, and the first one beyond.
        size = F.call_function("shiftleft", F.lit(1), level)
        low, high = F.ceil(_number(start) / size).cast("int"), F.floor(_number(end) / size).cast("int")
        inside = low < high
        left = F.when(inside & (low % 2 == 1), F.struct(level.alias("level"), low.alias("node")))
        right = F.when(inside & (high % 2 == 1), F.struct(level.alias("level"), (high - 1).alias("node")))
        return F.array(left, right)

    levels = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), at)
    return F.array_compact(F.flatten(levels))


def range_join(rows: DataFrame, day: str, windows: DataFrame, bound: int = DAY_ROWS) -> DataFrame:
    """Join rows to the windows [start, end) their day lies in, for windows held in a table.

    A window is laid out as its dyadic nodes, two per level at most, so one that is open to the end
    of the calendar is some forty rows. A row meets the node of its day on each level that windows
    use. A day with more than ``bound`` rows is salted: its rows are dealt to lanes, and the nodes
    above it are repeated for each. Rows without a day meet none.
    """
    nodes = windows.where("start < end").withColumn("_n", F.explode(dyadic_nodes(F.col("start"), F.col("end"))))
    nodes = nodes.select(*windows.columns, F.col("_n.level").alias("_level"), F.col("_n.node").alias("_node"))
    # At most LEVELS numbers, and at most one row per day of the calendar.
    used = sorted(r[0] for r in nodes.select("_level").distinct().collect())
    heavy = rows.groupBy(F.col(day).alias("_day")).count().where((F.col("count") > bound) & F.col("_day").isNotNull())
    heavy = heavy.select("_day", F.ceil(F.col("count") / bound).cast("int").alias("_lanes"))
    node_at = lambda level: F.call_function("shiftright", _number(F.col("_day")), level)
    levels = F.array(*[F.lit(level) for level in used]).cast("array<int>")
    above = heavy.withColumn("_level", F.explode(levels)).withColumn("_node", node_at(F.col("_level")))
    above = above.groupBy("_level", "_node").agg(F.max("_lanes").alias("_lanes"))
    laned = nodes.join(above, ["_level", "_node"], "left")
    laned = laned.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.coalesce("_lanes", F.lit(1)) - 1))).drop("_lanes")

    dealt = rows.withColumn("_day", F.col(day)).join(F.broadcast(heavy), "_day", "left")
    lane = F.pmod(F.monotonically_increasing_id(), F.coalesce("_lanes", F.lit(1))).cast("int")
    dealt = dealt.withColumn("_lane", lane).withColumn("_level", F.explode(levels)).withColumn("_node", node_at(F.col("_level")))
    joined = dealt.join(laned, ["_level", "_node", "_lane"])
    return joined.select(*[dealt[c] for c in rows.columns], *[laned[c] for c in windows.columns])
