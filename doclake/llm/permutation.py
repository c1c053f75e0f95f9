"""Approximate nearest neighbours by cosine: a permutation index.

A bounded sample of vectors serves as pivots. Every vector is represented by its nearest pivots in
order, and posted in the inverted file of each of them with the place it gives that pivot. A query
adds up, pivot by pivot of its own list, how far the places differ (the footrule distance; a vector
that is not in a pivot's file counts as placed last), reranks the nearest share by exact cosine,
and keeps the best. Files are kept per block of vectors, so a task holds one block of vectors and
one of queries, whatever the table's size (see topk.in_blocks).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import add_columns
from doclake.llm.topk import QUERIES_PER_BLOCK, ROWS_PER_BLOCK, distinct_queries, finite, in_blocks, lists, merged, numbered, smallest

# Bounds of the sample the pivots are chosen from, and of the list kept of each vector.
PIVOTS = 256
NEAREST = 128
# Share of a block's vectors whose cosine is computed, and how many at least.
SHARE = 0.2
AT_LEAST = 1000

FOUND = "query_row long, vec_id long, score double"


def vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, vector`` of the rows that can be searched.

    Rows without id, vectors that are null, empty or zero, and those that hold null or non-finite
    components take no part.
    """
    usable = F.col(vec_id).isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0)
    return rows.where(usable).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of numbers; shorter vectors are filled up with zeros, longer than ``width`` widen it."""
    if isinstance(column, pa.Array):
        column = pa.chunked_array([column])
    values, lengths = lists(column, np.float64)
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    # Exact scaling by a power of two where squares would overflow or vanish.
    top = np.abs(out).max(axis=1, initial=0.0)
    far = (top > 1e100) | ((top < 1e-100) & (top > 0))
    if far.any():
        out[far] = np.ldexp(out[far], -np.frexp(top[far])[1][:, None])
    return out


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix * matrix).sum(axis=1))


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """At most ``pivots`` different directions, from the 4 x ``pivots`` rows whose id hashes lowest."""
    sample = rows.select("id", "vector").orderBy(F.xxhash64("id"), "id", "vector").limit(4 * pivots).collect()
    width = max((len(r.vector) for r in sample), default=0)
    matrix = _matrix(pa.array([r.vector for r in sample], pa.list_(pa.float64())), width)
    matrix /= _norms(matrix)[:, None]
    _, first = np.unique(np.round(matrix, 9), axis=0, return_index=True)
    return matrix[np.sort(first)[:pivots]]


def index(rows: DataFrame, pivots: np.ndarray, nearest: int = NEAREST) -> DataFrame:
    """Every row of ``id, vector`` with ``places``: its nearest pivots, nearest first.

    The table can be written and searched later with the same pivots. Columns besides id and
    vector are kept; one named places is replaced.
    """
    nearest = min(nearest, len(pivots))

    def start():
        def step(column: pa.Array) -> list[pa.Array]:
            matrix = _matrix(column, pivots.shape[1])
            wide = np.zeros((len(pivots), matrix.shape[1]))
            wide[:, : pivots.shape[1]] = pivots
            order = np.argsort(-(matrix @ wide.T), axis=1, kind="stable")[:, :nearest].astype(np.int32)
            offsets = np.arange(len(matrix) + 1, dtype=np.int32) * nearest
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(order.ravel()))]

        return step

    return add_columns(rows, start, "places array<int>", ["vector"])


def _block(queries: pa.Table, rows: pa.Table, k: int, share: float, at_least: int) -> pa.Table:
    ids, matrix = rows["id"].to_numpy(), _matrix(rows["vector"])
    q_ids, q_rows, q_matrix = queries["id"].to_numpy(), queries["row"].to_numpy(), _matrix(queries["vector"], matrix.shape[1])
    if q_matrix.shape[1] > matrix.shape[1]:
        matrix = np.pad(matrix, ((0, 0), (0, q_matrix.shape[1] - matrix.shape[1])))
    norms, q_norms = _norms(matrix), _norms(q_matrix)
    places, lengths = lists(rows["places"], np.int64)
    q_places, q_lengths = lists(queries["places"], np.int64)
    nearest = int(lengths.max(initial=0))
    owner = np.repeat(np.arange(len(ids)), lengths)
    place = np.arange(len(places)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.argsort(places, kind="stable")
    starts = np.searchsorted(places[order], np.arange(places.max(initial=-1) + 2))
    files = [(owner[o], place[o].astype(np.int32)) for o in np.split(order, starts[1:-1])] if len(places) else []
    budget = max(at_least, math.ceil(share * len(ids)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, end in enumerate(np.cumsum(q_lengths)):
        distance = np.full(len(ids), nearest * (nearest + 1) // 2, np.int32)
        for at, pivot in enumerate(q_places[end - q_lengths[i] : end].tolist()):
            if pivot < len(files):
                posted, given = files[pivot]
                distance[posted] += np.abs(given - at) - (nearest - at)
        others = np.flatnonzero(ids != q_ids[i])
        near = others[smallest(distance[others], ids[others], budget)]
        # Row by row in the same order of additions: equal vectors have equal scores.
        score = (matrix[near] * q_matrix[i]).sum(axis=1) / (norms[near] * q_norms[i])
        best = smallest(-score, ids[near], k)
        out.append((np.full(len(best), q_rows[i]), ids[near][best], score[best]))
    return pa.table(dict(zip(("query_row", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))


def search(
    queries: DataFrame,
    indexed: DataFrame,
    k: int,
    share: float = SHARE,
    at_least: int = AT_LEAST,
    rows_per_block: int = ROWS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The k nearest found for every query: query_id, rank, vec_id, score (the exact cosine).

    Both sides come from ``index`` with the same pivots. A row with the query's id is its own and is
    left out; fewer rows than k: all of them. Ties go to the smaller id, also where a block's share
    is cut, so of many equal vectors the smallest ids are found. Vectors of different lengths are
    compared as if the shorter had zeros. A repeated id is judged row by row: every query row has a list
    of its own, equal rows equal lists. Empty tables give no
    rows. Columns besides id, vector and places are not read.
    """
    asked, searched = (side.select("id", "vector", "places") for side in (queries, indexed))
    asked, searched = distinct_queries(asked), numbered(searched)

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            empty = {"query_row": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
            return pa.table({n: pa.array([], t) for n, t in empty.items()})
        return _block(left, right, k, share, at_least)

    found = in_blocks(asked, searched, rows_per_block, queries_per_block).applyInArrow(block, FOUND)
    return merged(found, asked, k)


