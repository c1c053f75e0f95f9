"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import column, free_name
from doclake.sources.workspace import TEXTS, materialize

ROUNDS = 60


def _to_least(pairs: DataFrame, upward: bool) -> DataFrame:
    """Every node's neighbours linked to the least node of the neighbourhood.

    ``pairs`` holds each link from both ends for the large star (only larger neighbours move), and
    from the larger end for the small star (the node itself moves too).
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    # Only the least neighbour is aggregated; the links themselves are joined, so that a node with
    # very many links is split by the skew join.
    joined = pairs.join(least, "u")
    if upward:
        moved = joined.where("v > u")
    else:
        moved = joined.select("v", "m").union(least.select(F.col("u").alias("v"), "m"))
    return moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``, where root is the least node of its component.

    Links to itself and nulls are ignored, repeated links count once. Each round is written to the
    shared folder, which also ends its lineage. No edges: no rows.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialize(links, "links")
    before = None
    for _ in range(ROUNDS):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, upward=True).distinct()
        links = materialize(_to_least(large, upward=False).distinct(), "links")
        # The links are unchanged exactly if every node hangs on its root.
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def first_of_each(docs: DataFrame, grouping: Callable[[DataFrame], DataFrame], doc_id: str, text: str) -> DataFrame:
    """One row of each component: that of the smallest id, a null id after all others.

    ``grouping`` makes ``row, component`` of ``row, text``. Rows are told apart by a written key, not
    by their id: rows that repeat an id stay if they are in different components. Of several rows
    with the smallest id the one whose text hashes lowest stays, and of equal texts the first read.
    """
    key = free_name(docs, "_row")
    written = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-rows", TEXTS)
    value = F.coalesce(column(text), F.lit(""))
    grouped = grouping(written.select(F.col(key).alias("row"), value.alias("text")))
    place = F.struct(column(doc_id).isNull().alias("last"), column(doc_id).alias("id"), F.xxhash64(value).alias("hash"), F.col(key).alias("row"))
    placed = written.select(F.col(key).alias("row"), place.alias("place"))
    chosen = grouped.join(placed, "row").groupBy("component").agg(F.min("place").alias("place"))
    kept = materialize(chosen.select(F.col("place.row").alias(key)), "kept-rows")
    return written.join(kept, key, "left_semi").select(*[column(c) for c in docs.columns])
