"""Pairs of large groups whose sets share most of their keys."""

from __future__ import annotations

from itertools import combinations

import numpy as np

from doclake.llm import jaccard

# Sets, keys, and the chance that a set has a key.
SETS, KEYS, SHARE = 90, 60, 0.7


def _group(spark):
    deal = np.random.default_rng(11)
    keys = deal.integers(-(2**62), 2**62, KEYS)
    has = deal.random((SETS, KEYS)) < SHARE
    has[-8:] = False  # a small bucket of its own, and one pair that meets in it alone
    rows = [(int(keys[k]), s) for s in range(SETS) for k in range(KEYS) if has[s, k]]
    rows += [(5, s) for s in range(SETS - 8, SETS)] + [(6, 0), (6, SETS - 1)]
    shared = spark.createDataFrame(rows, "key long, set_id long")
    sketch = jaccard.sketch_of(np.arange(40, dtype=np.uint64), 128)
    known = spark.createDataFrame([(s, 40, bytearray(sketch)) for s in range(SETS)], "set_id long, n long, sketch binary")
    roots = spark.createDataFrame([(s, s % 2) for s in range(0, SETS, 3)], "node long, root long")
    component = {s: s % 2 if s % 3 == 0 else s for s in range(SETS)}
    of = {}
    for key, s in rows:
        of.setdefault(key, set()).add(s)
    expected = {p for each in of.values() for p in combinations(sorted(each), 2) if component[p[0]] != component[p[1]]}
    return shared, known, roots, expected


def test_a_pair_of_many_shared_keys_is_made_once(spark):
    shared, known, roots, expected = _group(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = [tuple(r) for r in jaccard.made_pairs(shared, known, roots).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(made) == expected
    assert len(made) < 1.2 * len(expected)


def test_marks_choose_one_bucket():
    top = np.iinfo(np.int64).max
    left, right = np.array([[3, 9, top], [3, 9, top], [1, 2, top]]), np.array([[4, 9, top], [3, 9, top], [5, 6, top]])
    assert jaccard.made_here(9, left, right).tolist() == [True, False, True]
    assert jaccard.made_here(3, left, right).tolist() == [False, True, True]
