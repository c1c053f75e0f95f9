"""The Jaccard join against brute force; bounds and keys on their own."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from doclake.llm import jaccard
from doclake.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs):
    sets = [brute_set(text) for _, text in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    least = {}
    for at, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(at)] = min(doc_id, least.get(find(at), doc_id))
    return sorted(((d, len(s), least.get(find(at))) for at, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=repr)


def found(spark, docs):
    rows = jaccard.group(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def edited(dice, words, share):
    return [dice.choice("xyz") + str(dice.randrange(99)) if dice.random() < share else w for w in words]


def test_random_texts(spark):
    dice = random.Random(1)
    docs = []
    for _ in range(60):
        words = [f"w{dice.randrange(400)}" for _ in range(dice.choice([1, 3, 5, 6, 7, 9, 12, 14, 20, 30, 60, 120, 300]))]
        docs.append(" ".join(words))
        for _ in range(dice.randrange(5)):
            docs.append(" ".join(edited(dice, words, dice.choice([0.0, 0.01, 0.02, 0.03, 0.05]))))
        if dice.random() < 0.3:
            docs.append(" ".join(words + words[:3]))
    docs = list(enumerate(docs))
    dice.shuffle(docs)
    want = brute(docs)
    assert found(spark, docs) == want
    assert len({r[2] for r in want}) < len(want) - 30


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    docs = [(None, "a b c d e f"), (None, "A b c d e f"), (5, "a b c d e  f"), (7, None), (8, ""), (9, " \t"), (10, "one two"), (11, "ONE\ntwo"), (12, "two one"), (12, "two one"), (None, "only here"), (13, "é É"), (14, "É é")]
    assert found(spark, docs) == brute(docs)
    assert found(spark, []) == []


@pytest.mark.parametrize("band", [0, 3, 5, 8, 12, 18, 25, 35])
def test_similar_sets_share_a_key(band):
    dice = np.random.default_rng(band)
    low, high = int(np.ceil(jaccard.RATIO**band)), int(np.ceil(jaccard.RATIO ** (band + 1))) - 1
    for size in {low, high}:
        if jaccard.band_of(size) != band:
            continue
        most = size // 4
        for _ in range(60 if size < 500 else 5):
            base = dice.integers(0, 1 << 63, size + most, np.uint64)
            left = np.unique(base[:size])
            gone = dice.integers(0, most + 1)
            right = np.unique(base[gone : size + (most - gone)])
            common = len(np.intersect1d(left, right))
            if 100 * common < 80 * (len(left) + len(right) - common):
                continue
            bands = [{b, b - 1} for b in map(jaccard.band_of, (len(left), len(right)))]
            assert bands[0] & bands[1]
            assert any(np.intersect1d(jaccard.segment_keys(left, b), jaccard.segment_keys(right, b)).size for b in bands[0] & bands[1] if b >= 0)
            sketches = [np.frombuffer(jaccard.sketch_of(s, jaccard.sketch_bits(jaccard.band_of(len(s)))), np.uint8) for s in (left, right)]
            apart = jaccard.distance(*sketches)
            assert apart <= len(left) + len(right) - 2 * common
            assert jaccard.may_link(len(left), len(right), apart)


def test_one_passage_in_all_makes_few_pairs(spark):
    dice = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, passage + " " + " ".join(f"w{dice.randrange(10**6)}" for _ in range(30 + i % 7))) for i in range(400)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    slim = rows.selectExpr("doc_id", "xxhash64(text) as text_key", "text")
    made = jaccard.sets(slim)
    shared = jaccard.shared_keys(made)
    known = made.select("set_id", "n", "sketch")
    roots = spark.createDataFrame([], "node long, root long")
    assert jaccard.crossing_pairs(shared, known, roots).count() <= 400
    assert len({r[2] for r in found(spark, docs)}) == 400


def test_blocks_of_a_large_bucket(spark):
    base = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join([*base[: 40 + i % 3], f"x{i}", *base[41:]])) for i in range(60)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    made = jaccard.sets(rows.selectExpr("doc_id", "xxhash64(text) as text_key", "text"))
    shared, known = jaccard.shared_keys(made), made.select("set_id", "n", "sketch")
    roots = spark.createDataFrame([], "node long, root long")
    whole = {tuple(r) for r in jaccard.crossing_pairs(shared, known, roots).collect()}
    assert whole and {tuple(r) for r in jaccard.crossing_pairs(shared, known, roots, bucket=8).collect()} == whole
    assert found(spark, docs) == brute(docs)
