"""Repeated query rows and ids in both searches."""

from __future__ import annotations

import math

import numpy as np
import pytest

from doclake.llm import permutation, topk


def data(spark):
    """Vectors of which one id holds a third; queries of which one repeats and one id has two vectors."""
    rng = np.random.default_rng(8)
    rows = [(i if i % 3 else 900, [float(x) for x in rng.integers(-9, 10, 6)]) for i in range(300)]
    asked = [rows[1], rows[1], rows[1], (rows[2][0], rows[4][1]), rows[2], rows[5]]
    return rows, asked, *(spark.createDataFrame(r, "vec_id long, embedding array<float>") for r in (rows, asked))


def lists(frame, k):
    """The lists of each query id; a list is told from another by its ranks."""
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(float(r.score), 6)))
    return {i: sorted(found) for i, found in out.items()}


def want(rows, asked, k, score):
    out = {}
    for i, q in asked:
        best = sorted((-score(q, v), j) for j, v in rows if j != i)[:k]
        out.setdefault(i, []).extend((n + 1, j, round(float(-s), 6)) for n, (s, j) in enumerate(best))
    return {i: sorted(found) for i, found in out.items()}


@pytest.mark.parametrize("blocks", [(8192, 1024), (40, 2)])
def test_repeated_queries_have_whole_lists(spark, blocks):
    rows, asked, row_frame, asked_frame = data(spark)
    sparse = [topk.sparse_rows(f, "vec_id", "embedding", 16) for f in (asked_frame, row_frame)]
    inner = lambda a, b: sum(math.floor(16 * x) * math.floor(16 * y) for x, y in zip(a, b, strict=True))
    assert lists(topk.top_k(*sparse, 10, *blocks), 10) == want(rows, asked, 10, inner)
    vectors = [permutation.vectors(f, "vec_id", "embedding") for f in (asked_frame, row_frame)]
    pivots = permutation.choose_pivots(vectors[1], 16)
    found = permutation.search(*[permutation.index(v, pivots) for v in vectors], 5, 1.0, 1, *blocks)
    cosine = lambda a, b: np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b))
    assert {i: [s for *_, s in f] for i, f in lists(found, 5).items()} == {i: [s for *_, s in f] for i, f in want(rows, asked, 5, cosine).items()}


def test_no_block_exceeds_its_bound(spark):
    rows = spark.createDataFrame([(7,)] * 200 + [(i,) for i in range(103)], "id long").repartition(5)
    numbers = sorted(r["row"] for r in topk.numbered(rows).collect())
    assert numbers == list(range(303))
    sized = topk.in_blocks(topk.numbered(rows.limit(3)), topk.numbered(rows), 50, 10).applyInArrow(
        lambda left, right: right.select(["id"]).slice(0, 1).append_column("n", [[right.num_rows]]), "id long, n long"
    )
    sizes = [r.n for r in sized.collect()]
    assert len(sizes) == 7 and max(sizes) <= 50 and sum(sizes) == 303
