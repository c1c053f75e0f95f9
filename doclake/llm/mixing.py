"""Mixing sources to target weights: a time-varying curriculum. Native throughout.

A source's target is its share, by weight, of a budget of words; no target exceeds a multiple of
what the source has. Over the training time 0 to 1 a source is consumed at the rate of its
schedule, a straight line that integrates to the target: fading sources come early, rising ones
late. A copy of a document that begins after x words of its source's demand gets the position t at
which the integrated schedule reaches x, and the mix is the copies in range-sorted order of t.

The order within a source is that of a checksum. Running sums are made in lanes: ranges of rows, not
of values, in the order of source and checksum. A source with a third of all rows is a third of the
lanes, and so is an id that repeats that often: a written row number is the last key of the order.

All planning is done on slim rows. Text moves when copies are made: once to meet its positions, and
once to its place in the mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import WORD, column, free_name
from doclake.sources.workspace import TEXTS, materialize

WEIGHTS = (5, 2, 1)
# How the rate at the end of training differs from the mean rate, for the weights in turn.
RAMPS = (-0.5, 0.0, 0.5)
BUDGET = 1.5
MOST = 2.0


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(rows: DataFrame, order: Column) -> DataFrame:
    """Adds ``number``, the position in the order from 0, without a window over all rows."""
    placed = materialize(rows.orderBy(order).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    part, within = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_at": within})
    # One row per partition of the sort.
    before = F.sum("rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = placed.groupBy("_part").agg(F.count("*").alias("rows")).select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").withColumn("number", F.col("_start") + F.col("_at")).drop("_id", "_part", "_at", "_start")


def targets(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, ramps: Sequence[float] = RAMPS, budget: float = BUDGET, most: float = MOST
) -> DataFrame:
    """One row per source: source, source_size, ramp and target, from rows with source and size.

    Sources in code point order, null last, take the weights in turn. A target stops at ``most``
    times the source's size; the excess is shared out again by weight until none is above.
    """
    sizes = documents.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = _numbered(sizes, F.col("source").asc_nulls_last())
    turn = F.col("number") % len(weights)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (turn + 1).cast("int"))
    sources = sources.withColumns({"weight": pick(weights), "ramp": pick(ramps).cast("double")})

    limit = F.lit(float(most)) * F.col("source_size")
    rate, stopped = float("inf"), -1
    # A round fixes at least one more source, or is the last; the rounds are sums over one row per source.
    total = sources.agg(F.sum("source_size")).head()[0] or 0
    rate, weight_left, held = 0.0, 0, 0.0
    while True:
        above = F.col("weight") * F.lit(rate) > limit
        row = sources.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("left"),
        ).head()
        if row["n"] == stopped:
            break
        stopped, held, weight_left = row["n"], row["held"], row["left"]
        rate = (budget * total - held) / weight_left if weight_left else rate
    target = F.when(F.col("weight") * F.lit(rate) > limit, limit).otherwise(F.col("weight") * F.lit(rate))
    return sources.select("source", "source_size", "ramp", target.alias("target"))


def _position(demand: Column, ramp: Column) -> Column:
    """When a share of the demand is reached: solves t + ramp * (t * t - t) = demand."""
    flat = 1 - ramp
    below = flat + F.sqrt(flat * flat + 4 * ramp * demand)
    return F.when(below > 0, 2 * demand / below).otherwise(0.0)


def sizes(documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", key: str | None = None) -> DataFrame:
    """``doc_id, source, size, tie, row``, written once: the slim rows that are planned.

    ``tie`` is a hash of the text, ``row`` a number of the row or the column ``key``.
    """
    row = column(key) if key else F.monotonically_increasing_id()
    slim = documents.select(
        column(doc_id).alias("doc_id"),
        column(source).alias("source"),
        words(column(text)).alias("size"),
        F.xxhash64(column(text)).alias("tie"),
        row.alias("row"),
    )
    return materialize(slim, "sizes")


def plan(slim: DataFrame, shares: DataFrame) -> DataFrame:
    """What the mix takes of every row of ``sizes``: its columns, and source_size, target, taken, copies.

    ``shares`` comes from ``targets``. Every document is taken whole as often as the target covers
    the whole source; the rest of the target takes the documents that come first by checksum once
    more, the last one in part, so the words taken of a source add up to its target, rounded.
    ``copies`` lists position and words of each. Null sources are one source, null ids one checksum.
    Rows of one id and size are taken in the order of their texts, and equal rows in any. Empty
    documents are copied as often as the source is covered whole. An empty table gives no rows.
    """
    parts = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = slim.withColumn("digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = ["digest", "doc_id", "size", "tie", "row"]
    dealt = keyed.repartitionByRange(parts, "source", *order).withColumn("lane", F.spark_partition_id())
    dealt = materialize(dealt, "mixing-lanes")
    # A row per lane, and one more per source that begins inside a lane.
    lanes = dealt.groupBy("source", "lane").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    lanes = lanes.join(shares.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    lanes = lanes.select(F.col("source").alias("_source"), F.col("lane").alias("_lane"), "before", "source_size", "target", "ramp")

    inside = Window.partitionBy("source", "lane").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = summed.join(lanes, F.col("source").eqNullSafe(F.col("_source")) & (F.col("lane") == F.col("_lane")))
    start, size, whole = F.col("before") + F.col("inside"), F.col("size"), F.col("source_size")
    times = F.when(whole > 0, F.floor(F.col("target") / whole)).otherwise(0).cast("long")
    more = F.greatest(F.lit(0), F.least(size, F.round("target").cast("long") - times * whole - start)).cast("long")

    def copy(turn: Column, words: Column) -> Column:
        # The last, partial round may lie beyond the target by its rounding.
        demand = F.least(F.lit(1.0), F.when(F.col("target") > 0, (turn * whole + start) / F.col("target")).otherwise(0.0))
        return F.struct(_position(demand, F.col("ramp")).alias("position"), words.alias("words"))

    full = F.when(times > 0, F.transform(F.sequence(F.lit(0).cast("long"), times - 1), lambda i: copy(i, size)))
    last = F.when(more > 0, F.array(copy(times, more)))
    none = F.array().cast("array<struct<position:double,words:bigint>>")
    return placed.select(
        *slim.columns,
        "source_size",
        "target",
        (times * size + more).cast("long").alias("taken"),
        F.concat(F.coalesce(full, none), F.coalesce(last, none)).alias("copies"),
    )


def mix(documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: the documents' columns, a row per copy, range-sorted by position.

    A copy of which less than half is taken is left out and any other is kept whole: a document is
    never cut. Nulls, repeats and empty tables as in ``plan``; columns besides the three named are
    carried along whatever their names.
    """
    key = free_name(documents, "_row")
    written = materialize(documents.withColumn(key, F.monotonically_increasing_id()), "keyed-rows", TEXTS)
    slim = sizes(written, doc_id, source, text, key)
    planned = plan(slim, targets(slim))
    whole = F.filter("copies", lambda c: c["words"] * 2 >= F.col("size"))
    at = free_name(documents, "_position")
    copies = planned.select(F.col("row").alias(key), F.explode(whole).alias("copy")).select(key, F.col("copy.position").alias(at))
    copies = materialize(copies, "copies")
    placed = written.join(copies, key)
    return placed.orderBy(column(at), column(key)).select(*[column(c) for c in documents.columns])
