"""What happens to an identity over a batch: last write, change, write decision, upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.schema import IDENTITY
from doclake.sources.workspace import materialize

# Rows of one identity that one window group may hold; a longer history is cut into lanes.
GROUP_ROWS = 1 << 20
# Heavy identities are looked for in one row of so many.
SAMPLE = 16


def latest_per_identity(
    rows: DataFrame, order: str = "fetch_seq", keys: Sequence[str] = IDENTITY, **extra: Column
) -> DataFrame:
    """Last write wins. An aggregate, not a window: each task sends one row per identity on.

    ``extra`` adds further aggregates over all rows of the identity.
    """
    values = [c for c in rows.columns if c not in keys]
    latest = F.max_by(F.struct(*values), F.col(order)).alias("latest")
    more = [column.alias(name) for name, column in extra.items()]
    return rows.groupBy(*keys).agg(latest, *more).select(*keys, "latest.*", *extra)


def lanes(rows: DataFrame, order: str = "fetch_seq", keys: Sequence[str] = IDENTITY) -> DataFrame:
    """Rows with ``_lane``: ranges of (identity, order) of about equal size, written once.

    The ranges are of positions, not of numbers, so the numbers may be as sparse as they like, and
    an identity with a third of all rows lies in a third of the lanes. The table is written because
    two readers have to see the same ranges.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys, order).withColumn("_lane", F.spark_partition_id())
    return materialize(dealt, "lanes")


def heavy_identities(
    rows: DataFrame, bound: int, order: str = "fetch_seq", keys: Sequence[str] = IDENTITY
) -> DataFrame | None:
    """Identities with more than about ``bound`` rows, or None; there are at most rows / bound.

    Judged by a sample of the rows, chosen by hash: a light identity taken for a heavy one, or the
    other way round, changes where its rows are compared and not what comes out.
    """
    if rows.count() <= bound:
        return None
    picked = rows.where(F.pmod(F.xxhash64(order), F.lit(SAMPLE)) == 0) if bound >= 4 * SAMPLE else rows
    limit = bound // SAMPLE if bound >= 4 * SAMPLE else bound
    heavy = picked.groupBy(*keys).count().where(F.col("count") > limit).drop("count")
    heavy = materialize(heavy, "heavy-identities")
    return None if heavy.isEmpty() else heavy


def mark_changes(
    rows: DataFrame,
    values: Sequence[str],
    order: str = "fetch_seq",
    keys: Sequence[str] = IDENTITY,
    bound: int = GROUP_ROWS,
) -> DataFrame:
    """Add ``is_first`` (of its identity) and ``changed`` (first, or values unlike the row before).

    ``rows`` are counted first, so they should be read from a table. An identity's history is one window
    group, unless it has more than ``bound`` rows: those few are compared in lanes, so that one that owns
    a third of the table is no group of its own.

    Rows of an identity that share their order are ``repeated``: which of them came first is not
    known. They count for nothing, neither as first nor as changed nor as predecessor.
    """
    heavy = heavy_identities(rows, bound, order, keys)
    if heavy is None:
        return _compared(rows, values, order, keys)
    light = rows.join(heavy, list(keys), "left_anti").select(*rows.columns)
    rest = rows.join(heavy, list(keys), "left_semi").select(*rows.columns)
    return _compared(light, values, order, keys).unionByName(_compared_in_lanes(rest, values, order, keys))


def _before(rows: DataFrame, values: Sequence[str], order: str, group: Sequence[str]) -> DataFrame:
    """Add ``repeated`` and ``_before``, the values of the last single row before in the group."""
    inside = Window.partitionBy(*group).orderBy(order)
    twice = [F.col(order).eqNullSafe(near(order).over(inside)) for near in (F.lag, F.lead)]
    marked = rows.withColumn("repeated", twice[0] | twice[1])
    counted = F.when(~F.col("repeated"), F.struct(*values))
    last = F.last(counted, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return marked.withColumn("_before", last)


def _decided(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    there = F.col("_before").isNotNull()
    same = reduce(Column.__and__, [F.col(v).eqNullSafe(F.col(f"_before.{v}")) for v in values])
    single = ~F.col("repeated")
    marked = rows.withColumns({"is_first": single & ~there, "changed": single & ~(there & same)})
    return marked.drop("_before")


def _compared(rows: DataFrame, values: Sequence[str], order: str, keys: Sequence[str]) -> DataFrame:
    return _decided(_before(rows, values, order, keys), values)


def _compared_in_lanes(
    rows: DataFrame, values: Sequence[str], order: str, keys: Sequence[str]
) -> DataFrame:
    """The same, with the look-back inside lanes.

    Only the first identity of a lane can have its predecessor in another one, and then it is the
    last row of the lane before. Those last rows, one per lane, are all that is carried over.
    """
    dealt = lanes(rows, order, keys)
    marked = _before(dealt, values, order, [*keys, "_lane"])
    ends = (
        marked.where(~F.col("repeated"))
        .groupBy("_lane")
        .agg(F.max_by(F.struct(*keys, F.struct(*values).alias("state")), F.struct(*keys, order)).alias("_end"))
    )
    # One row per lane, that is per shuffle partition: bounded by the setting, whatever the input.
    numbers = dealt.groupBy("_lane").agg(F.count("*").alias("rows"))
    so_far = Window.orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    carried = numbers.join(ends, "_lane", "left").select(
        "_lane", F.last("_end", ignorenulls=True).over(so_far).alias("_end")
    )
    joined = marked.join(F.broadcast(carried), "_lane")
    same_key = reduce(Column.__and__, [F.col(f"_end.{k}").eqNullSafe(F.col(k)) for k in keys])
    before = F.coalesce("_before", F.when(F.col("_end").isNotNull() & same_key, F.col("_end.state")))
    return _decided(joined.withColumn("_before", before).drop("_lane", "_end"), values)


def join_existing(rows: DataFrame, stored: DataFrame, *fields: str) -> DataFrame:
    """Rows with the stored record of their identity as struct ``existing`` (null when new)."""
    known = stored.select(*IDENTITY, F.struct(*fields).alias("existing"))
    return rows.join(known, list(IDENTITY), "left")


def write_decisions(
    writes: DataFrame,
    stored: DataFrame,
    keys: Sequence[str] = IDENTITY,
    bound: int = GROUP_ROWS,
) -> DataFrame:
    """Decide for every write, in arrival order, whether the object has to be written.

    A write is unchanged only if hash and path equal those of the write just before it, so
    A, B, A writes three times. The stored record takes part as write number -1: the look-back
    that compares neighbours then also finds stored state, without a join.

    ``writes`` needs the keys, fetch_seq (not negative), file_path, file_hash; every other column
    is carried along, so keep payloads out. Adds ``object_written``, ``inserted`` and ``repeated``,
    of writes of one identity under one number, which are not decided.
    """
    value = ["file_path", "file_hash"]
    before = stored.select(*keys, *value, F.lit(-1).cast("bigint").alias("fetch_seq"))
    history = writes.unionByName(before, allowMissingColumns=True)
    marked = mark_changes(history, value, keys=keys, bound=bound)
    renamed = marked.withColumnsRenamed({"changed": "object_written", "is_first": "inserted"})
    return renamed.where("fetch_seq >= 0")


def upsert(
    stored: DataFrame, batch: DataFrame, order: str = "fetch_seq", keys: Sequence[str] = IDENTITY
) -> DataFrame:
    """Stored table after the batch, one row per identity, plus ``action``."""
    latest = latest_per_identity(batch, order, keys)
    return merge(stored, latest if order in stored.columns else latest.drop(order), keys)


def merge(
    stored: DataFrame,
    latest: DataFrame,
    keys: Sequence[str] = IDENTITY,
    keep_when_null: Sequence[str] = (),
) -> DataFrame:
    """Merge a batch with one row per identity into the stored table and add ``action``.

    Columns the batch has overwrite, nulls included (but for ``keep_when_null``); columns only the
    stored table has keep their values. Both sides are unique on the key: no key is heavy here.
    """
    written = [c for c in latest.columns if c not in keys]
    kept = [c for c in stored.columns if c not in keys]
    source = latest.select(*keys, F.struct(F.lit(True).alias("hit"), *written).alias("source"))
    target = stored.select(*keys, F.struct(F.lit(True).alias("hit"), *kept).alias("target"))
    both = source.join(target, list(keys), "full_outer")
    in_source, in_target = F.col("source.hit").isNotNull(), F.col("target.hit").isNotNull()

    def value(name: str) -> Column:
        new = F.col(f"source.{name}") if name in written else None
        old = F.col(f"target.{name}") if name in kept else None
        if new is None or old is None:
            return old if new is None else new
        if name in keep_when_null:
            return F.coalesce(new, old)
        return F.when(in_source, new).otherwise(old)

    columns = [*kept, *[c for c in written if c not in kept]]
    action = F.when(in_source & in_target, "updated").when(in_source, "inserted").otherwise("kept")
    return both.select(*keys, *[value(c).alias(c) for c in columns], action.alias("action"))
