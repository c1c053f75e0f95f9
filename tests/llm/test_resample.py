"""Importance resampling against a version with plain dictionaries."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from doclake.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_features(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, buckets=10000, least=20, share=10, seed="2024"):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, aim = Counter(), Counter()
    for _, text in docs:
        own.update(map(bucket, brute_features(text, longest)[1]))
    for text in target:
        aim.update(map(bucket, brute_features(text, longest)[1]))
    all_own, all_aim = sum(own.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (all_own + buckets) / ((own[b] + 1) * (all_aim + buckets))))
    rows = []
    for doc_id, text in docs:
        words, features = brute_features(text, longest)
        weight = sum(gain(bucket(f)) for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(features), weight, score, None, len(words) >= least])
    competing = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, row in enumerate(competing[: len(competing) * share // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def corpus(n=240):
    dice = random.Random(2)
    texts = [" ".join(dice.choice(["alpha", "Beta", "gamma-ray", "é1", "Ünï", "x_y", "\x00z", "日本"]) for _ in range(dice.choice([3, 19, 20, 25, 90]))) for _ in range(n)]
    docs = list(enumerate(texts)) + [(None, texts[4]), (None, texts[4]), (3, texts[5]), (3, texts[5]), (1000, None), (1001, ""), (1002, "- _ -")]
    return docs, ["alpha beta", "Alpha 日本 é1", None, ""]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_against_brute_force(spark, longest):
    docs, target = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'c' as score", "1 as weight")
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    rows = resample.resample(frame.repartition(5), aim, longest=longest).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute(docs, target, longest)
    assert [f.name for f in resample.resample(frame, aim).schema] == ["doc_id", "n_features", "weight", "score", "rank"]


def test_words_in_utf8(spark):
    for text in ("Aé日_x\x7fy0", "", None, "a" * 100000 + " B", "\ud800x"):
        want = [w.encode("utf-8", "replace") for w in WORD.findall((text or "").translate(LOWER))]
        assert resample.words_of(text) == ([b"?x"[1:]] if text == "\ud800x" else want)


def test_chained_checksums():
    words = [b"one", b"two", b"three", b"four"]
    got = resample.features_of(words, 3, 1 << 32).tolist()
    assert got == [zlib.crc32(b" ".join(words[i : i + n])) for n in (1, 2, 3) for i in range(4 - n + 1)]
    assert resample.features_of(words[:1], 3, 7).tolist() == [zlib.crc32(b"one") % 7]


def test_nothing(spark):
    empty, aim = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert resample.resample(empty, aim).count() == 0
    docs, _ = corpus(30)
    rows = resample.resample(spark.createDataFrame(docs, "doc_id long, text string"), empty).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute(docs, [])


def test_gains_are_even_for_the_same_corpus():
    counts = np.array([5, 0, 7])
    assert resample.gains(counts, counts).tolist() == [0, 0, 0]
