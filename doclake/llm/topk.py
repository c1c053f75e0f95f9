"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

Queries and rows are sparse integer vectors: ``id long, terms array<int>, weights array<long>``.
Both are dealt into blocks of bounded size. A task meets one block of rows with one of queries:
it posts the rows by term, and each query's terms scatter their weighted postings into a dense
array of scores, one entry per row of the block; partition selection keeps the block's best k.
A window merges the blocks' lists, k entries each. Work is queries x rows, as the question is;
what is shuffled is each side once per block of the other, and what a task holds is two blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.sources.workspace import materialize

ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 1024

FOUND = "query_row long, vec_id long, score long"


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.expr(
        f"`{vector}` is not null and forall(`{vector}`, x -> x is not null"
        " and not isnan(x) and abs(double(x)) < double('infinity'))"
    )


def sparse_rows(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """Integer rows ``floor(scale * x)`` of dense vectors, without the zero components.

    Vectors that are null or hold null or non-finite components, and rows without id, take no part.
    """
    whole = F.expr(f"transform(`{vector}`, (x, i) -> struct(i as term, floor({scale} * double(x)) as weight))")
    kept = F.filter(whole, lambda e: e["weight"] != 0)
    return (
        vectors.where(F.col(vec_id).isNotNull() & finite(vector))
        .select(F.col(vec_id).cast("long").alias("id"), kept.alias("kept"))
        .select("id", F.col("kept.term").cast("array<int>").alias("terms"), F.col("kept.weight").cast("array<long>").alias("weights"))
    )


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, written, with ``row``: their number from 0 on."""
    written = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "numbered-rows")
    # The number within a partition is in the lower 33 bits, and without gaps.
    sizes = written.groupBy(F.shiftright("row", 33).alias("part")).count().orderBy("part").collect()
    starts, at = [], 0
    for size in sizes:
        starts.append((size["part"], at))
        at += size["count"]
    offsets = written.sparkSession.createDataFrame(starts, "part long, start long")
    placed = written.join(F.broadcast(offsets), F.shiftright("row", 33) == F.col("part"))
    return placed.withColumn("row", F.col("start") + F.col("row").bitwiseAND((1 << 33) - 1)).drop("part", "start")


def distinct_queries(queries: DataFrame) -> DataFrame:
    """Different query rows, numbered, with ``times``, how often each is there."""
    return numbered(queries.groupBy(*queries.columns).agg(F.count("*").alias("times")))


def in_blocks(queries: DataFrame, rows: DataFrame, rows_per_block: int, queries_per_block: int):
    """Both sides, numbered, grouped by (query block, row block); every pair of blocks meets once.

    Blocks are dealt by the rows' numbers: none is larger than its bound, whatever the ids are.
    """
    row_blocks = max(1, math.ceil(rows.count() / rows_per_block))
    query_blocks = max(1, math.ceil(queries.count() / queries_per_block))

    def dealt(side: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return side.withColumns(
            {own: F.pmod(F.col("row"), F.lit(blocks)), other: F.explode(F.sequence(F.lit(0), F.lit(others - 1)))}
        ).withColumn(other, F.col(other).cast("long"))

    keys = ("query_block", "row_block")
    left = dealt(queries, "query_block", query_blocks, "row_block", row_blocks)
    right = dealt(rows, "row_block", row_blocks, "query_block", query_blocks)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def lists(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and the length of each list."""
    column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype), lengths


def smallest(key: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest keys, ties to the smaller id, in that order."""
    if k < len(key):
        limit = np.partition(key, k - 1)[k - 1]
        at = np.flatnonzero(key <= limit)
    else:
        at = np.arange(len(key))
    return at[np.lexsort((ids[at], key[at]))[:k]]


def _block(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    ids = rows["id"].to_numpy()
    terms, lengths = lists(rows["terms"], np.int64)
    weights, _ = lists(rows["weights"], np.int64)
    owner = np.repeat(np.arange(len(ids)), lengths)
    order = np.argsort(terms, kind="stable")
    terms, weights, owner = terms[order], weights[order], owner[order]
    # A term that a row repeats adds up.
    first = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])][: len(terms)])
    if len(first) < len(terms):
        terms, weights, owner = terms[first], np.add.reduceat(weights, first), owner[first]
    starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(terms)]
    posting = {int(terms[a]): (owner[a:b], weights[a:b]) for a, b in zip(starts, ends, strict=True)}

    q_ids = queries["id"].to_numpy()
    q_terms, q_lengths = lists(queries["terms"], np.int64)
    q_weights, _ = lists(queries["weights"], np.int64)
    q_ends = np.cumsum(q_lengths)
    # Beyond 64 bits the sums are made of Python's integers and cut to the range of a long.
    high = max((abs(int(x)) for x in (weights.min(initial=0), weights.max(initial=0))), default=0)
    q_high = max(abs(int(q_weights.min(initial=0))), abs(int(q_weights.max(initial=0))))
    wide = high * q_high * max(1, int(q_lengths.max(initial=0))) >= 2**62
    kind = object if wide else np.int64
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query, number, end, length in zip(q_ids, queries["row"].to_numpy(), q_ends, q_lengths, strict=True):
        scores = np.zeros(len(ids), kind)
        for term, weight in zip(q_terms[end - length : end].tolist(), q_weights[end - length : end].tolist(), strict=True):
            if term in posting:
                at, values = posting[term]
                scores[at] += values.astype(kind) * weight
        if wide:
            scores = np.array([min(max(x, -(2**63) + 1), 2**63 - 1) for x in scores], np.int64)
        others = np.flatnonzero(ids != query)
        best = others[smallest(-scores[others], ids[others], k)]
        out.append((np.full(len(best), number), ids[best], scores[best]))
    columns = [np.concatenate(c).astype(np.int64) if out else np.zeros(0, np.int64) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("query_row", "vec_id", "score"), columns, strict=True)))


def merged(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best k of the blocks' lists for every query row: highest score first, ties to the smaller
    id. A query row that repeats has its list as often."""
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    asked = queries.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"), "times")
    back = ranked.join(asked, "query_row").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return back.select("query_id", "rank", "vec_id", "score")


def top_k(
    queries: DataFrame,
    rows: DataFrame,
    k: int,
    rows_per_block: int = ROWS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The k rows of highest inner product for every query: query_id, rank, vec_id, score.

    A row with the query's id is the query's own and is left out. Fewer rows than k: all of them.
    Ties go to the smaller id. Rows without common term score 0 and take part. A row without terms
    (an empty vector) scores 0 everywhere. Terms beyond a shorter vector count as 0. A repeated id
    is judged row by row: every query row has a list of its own, equal rows equal lists. Scores
    beyond a long are cut to its range. Empty tables give no rows. Columns besides id, terms and weights
    are not read. A term that a row repeats adds up.
    """
    asked, searched = (side.select("id", "terms", "weights") for side in (queries, rows))
    asked, searched = distinct_queries(asked), numbered(searched)

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_row", "vec_id", "score")})
        return _block(left, right, k)

    found = in_blocks(asked, searched, rows_per_block, queries_per_block).applyInArrow(block, FOUND)
    return merged(found, asked, k)
