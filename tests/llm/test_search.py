"""Exact top-k and the permutation index against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from doclake.llm import permutation, queries, topk
from doclake.llm.common import table

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, score string"


def by_query(frame):
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


def odd_vectors(spark, n=60):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)], "x") for i in range(n)]
    rows += [(n, None, "x"), (n + 1, [1.0, None, 2.0], "x"), (n + 2, [float("nan")] * 6, "x"), (n + 3, [float("inf")] * 6, "x")]
    rows += [(n + 4, [0.0] * 6, "x"), (n + 5, [], "x"), (n + 6, rows[7][1], "x"), (n + 7, rows[7][1], None), (None, [1.0] * 6, "x")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def exact(rows, query, k, score):
    found = [(-score(query[1], r[1]), r[0]) for r in rows if r[0] != query[0]]
    return [(i, -s) for s, i in sorted(found)[:k]]


def usable(rows, zero):
    kept = [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return [r for r in kept if zero or any(r[1])]


def pad(a, b):
    n = max(len(a), len(b))
    return [*a, *[0.0] * (n - len(a))], [*b, *[0.0] * (n - len(b))]


@pytest.mark.parametrize("blocks", [(8192, 1024), (7, 5)])
def test_topk_is_brute_force(spark, blocks):
    rows, frame = odd_vectors(spark)
    sparse = topk.sparse_rows(frame, "vec_id", "embedding", 1024)
    got = by_query(topk.top_k(sparse.where("id % 10 = 0"), sparse, 10, *blocks))
    inner = lambda a, b: sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(*pad(a, b), strict=True))
    kept = usable(rows, zero=True)
    assert got == {q[0]: exact(kept, q, 10, inner) for q in kept if q[0] % 10 == 0}


def test_topk_of_few_and_none(spark):
    rows = spark.createDataFrame([(1, [0], [2]), (2, [0, 0], [3, 4]), (3, [9], [2**62])], "id long, terms array<int>, weights array<long>")
    got = by_query(topk.top_k(rows.where("id = 1"), rows, 10))
    assert got == {1: [(2, 14), (3, 0)]}
    assert topk.top_k(rows.limit(0), rows, 3).count() == 0
    assert topk.top_k(rows, rows.limit(0), 3).count() == 0
    # A product beyond a long is cut to its range.
    wide = spark.createDataFrame([(1, [0], [2**62]), (2, [0], [2**62])], rows.schema)
    assert by_query(topk.top_k(wide.where("id = 1"), wide, 1)) == {1: [(2, 2**63 - 1)]}


def cosine(a, b):
    a, b = map(np.array, pad(a, b))
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


@pytest.mark.parametrize("blocks", [(8192, 1024), (11, 3)])
def test_index_finds_all_where_all_are_reranked(spark, blocks):
    rows, frame = odd_vectors(spark)
    vectors = permutation.vectors(frame, "vec_id", "embedding")
    indexed = permutation.index(vectors, permutation.choose_pivots(vectors, 16), 8)
    got = by_query(permutation.search(indexed.where("id % 10 = 0"), indexed, 5, 1.0, 1, *blocks))
    kept = usable(rows, zero=False)
    want = {q[0]: exact(kept, q, 5, cosine) for q in kept if q[0] % 10 == 0}
    assert {q: [s for _, s in found] for q, found in got.items()} == {q: pytest.approx([s for _, s in found]) for q, found in want.items()}


def test_equal_vectors_give_the_smallest_ids(spark):
    rows = [(i, [0.3, -0.2, 0.7], None) for i in range(300)] + [(1000 + i, [float(i % 7), 1.0, -2.0], None) for i in range(300)]
    vectors = permutation.vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    indexed = permutation.index(vectors, permutation.choose_pivots(vectors))
    got = by_query(permutation.search(indexed.where("id = 150"), indexed, 5, 0.01, 20))
    assert [i for i, _ in got[150]] == [0, 1, 2, 3, 4]


def test_extreme_components(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 0.0]), (2, [1e-300, 1e-300])]
    vectors = permutation.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    indexed = permutation.index(vectors, permutation.choose_pivots(vectors))
    assert by_query(permutation.search(indexed.where("id = 0"), indexed, 5))[0] == [(2, pytest.approx(1.0)), (1, pytest.approx(0.5**0.5))]


def test_registered_queries(spark):
    stored = [(r.vec_id, list(r.embedding)) for r in table(spark, DATA, "embeddings").collect()]
    matrix = np.array([v for _, v in stored], np.float64)
    whole = np.floor(1024 * matrix).astype(np.int64)
    ids = np.array([i for i, _ in stored])
    got = by_query(queries.op3_exact_topk(spark, DATA))
    for at in np.flatnonzero(ids % 100 == 0):
        scores = whole @ whole[at]
        order = [j for j in np.lexsort((ids, -scores)) if j != at][:10]
        assert got[ids[at]] == [(ids[j], scores[j]) for j in order]

    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    found = by_query(queries.op10_permutation_index(spark, DATA))
    hits = 0
    for at in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[at]
        near[at] = -2
        hits += len({int(i) for i in ids[np.argsort(-near)[:5]]} & {i for i, _ in found[ids[at]]})
    assert hits >= 0.9 * 5 * len(found)
    assert topk.top_k(*[topk.sparse_rows(table(spark, SMALL, "embeddings"), "vec_id", "embedding", 1024)] * 2, 3).count() > 0


def test_recall_of_a_small_share(spark):
    """With a fifth of the vectors reranked, as on large tables, at least 0.9 is found."""
    rows = permutation.vectors(table(spark, "/root/testdata/sf0.1", "embeddings"), "vec_id", "embedding")
    indexed = permutation.index(rows, permutation.choose_pivots(rows))
    got = by_query(permutation.search(indexed.where("id % 50 = 0"), indexed, 5, at_least=1))
    stored = rows.collect()
    ids, matrix = np.array([r.id for r in stored]), np.array([r.vector for r in stored])
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = 0
    for query, found in got.items():
        near = unit @ unit[ids == query][0]
        near[ids == query] = -2
        hits += len({int(i) for i in ids[np.argsort(-near)[:5]]} & {i for i, _ in found})
    assert hits >= 0.9 * 5 * len(got)
