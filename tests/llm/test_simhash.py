"""Golay keys by their defining properties, links and groups against brute force."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from doclake.llm import queries, simhash
from doclake.llm.common import table
from doclake.llm.components import connected

SMALL = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Of {id: fingerprint}: the smallest id reachable from each."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in prints}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize(
    "text",
    ["", " \t", "one", "One two THREE", "a b c d", "a b c d e", "É è\x1cx\x85y z w ÀB", "x " * 70000, None, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich"],
)
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == brute_fingerprint(text)


def test_golay_code():
    golay = simhash.Golay()
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 4000)
    index, real = golay.near(words)
    # Perfect: each word has one codeword within 3 bits; a word at 3 bits has five more at 4.
    assert set(real.sum(axis=1).tolist()) == {1, 6}
    # Words that differ in two bits share a codeword; with one bit, the nearest of one is enough.
    for flips in (1, 2):
        masks = np.array([sum(1 << b for b in rng.choice(23, flips, replace=False)) for _ in words])
        other, other_real = golay.near(words ^ masks)
        shared = (index[:, :, None] == other[:, None, :]) & real[:, :, None] & other_real[:, None, :]
        assert shared.any(axis=(1, 2)).all()
        if flips == 1:
            assert shared[:, 0].any(axis=1).all()


def test_keys_of_close_fingerprints_meet():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000).astype(np.uint64)
    masks = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in prints], np.uint64)
    keys = simhash.Keys()
    left = keys.step(pa.array(prints.view(np.int64)))[0].to_pylist()
    right = keys.step(pa.array((prints ^ masks).view(np.int64)))[0].to_pylist()
    for a, b in zip(left, right, strict=True):
        own_a, own_b = {k >> 1 for k in a if k & 1}, {k >> 1 for k in b if k & 1}
        assert own_a & {k >> 1 for k in b} or own_b & {k >> 1 for k in a}


def clusters(n, size, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        centre = int(rng.integers(0, 1 << 62))
        for _ in range(size):
            mask = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))
            out.append(centre ^ mask)
    return sorted(set(out))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 24])
def test_links_connect_all_that_are_close(spark, bucket):
    """Also where buckets are cut into blocks, and rows of a bucket go over batches."""
    prints = clusters(6, 60, 5)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "simhash long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, bucket).collect()]
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in edges)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = brute_components({p: p for p in prints})
    assert {p: find(p) for p in prints} == want


def test_components(spark):
    rng = np.random.default_rng(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 501 + i) for i in range(80)]
    random = [(int(a), int(b)) for a, b in rng.integers(1000, 1300, (140, 2))]
    edges = [*chain, *star, *random, (7, 7), *chain[:5], (None, 3), (-4, -9), (-4, 900)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n: n for e in edges for n in e if None not in e and e[0] != e[1]}

    def find(n):
        while nodes[n] != n:
            n = nodes[n]
        return n

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            nodes[y] = x
    assert got == {n: find(n) for n in nodes}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_and_keep_one(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base, "x"), (3, base.upper(), "x"), (9, base + " more", "x"), (4, "", None), (2, None, None), (8, "other text", "x")]
    rows += [(8, "other text", "x"), (None, base, "x"), (None, "nobody knows", "x"), (None, "nobody knows", "y"), (11, "alone here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Simhash string")
    got = simhash.group(docs).collect()
    assert len(got) == len(rows)
    prints = {at: brute_fingerprint(r[1]) for at, r in enumerate(rows)}
    component = brute_components(prints)
    ids = {}
    for at, root in component.items():
        ids.setdefault(root, []).append(rows[at][0])
    least = {root: min((i for i in of if i is not None), default=None) for root, of in ids.items()}
    want = sorted(((rows[at][0], signed(prints[at]), least[component[at]]) for at in prints), key=repr)
    assert sorted(((r.doc_id, r.simhash, r.component_id) for r in got), key=repr) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(2, None), (3, base.upper()), (8, "other text"), (11, "alone here")]
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["nobody knows"]
    assert simhash.group(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_registered_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    prints = {i: brute_fingerprint(t) for i, t in docs.items()}
    component = brute_components(dict(sorted(prints.items())))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash_dedup(spark, SMALL).collect()}
    assert got == {i: (f"{prints[i]:016x}", component[i]) for i in docs}


def test_rows_that_repeat_an_id_are_kept_by_component(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(400)) for c in "ab")
    rows = [(8, a), (8, b), (3, a), (8, a + " more"), (None, "x y z"), (None, "no id " + b[::-1]), (None, "No id " + b[::-1])]
    assert (brute_fingerprint(a) ^ brute_fingerprint(a + " more")).bit_count() <= 4
    for order in (rows, rows[::-1]):
        got = simhash.keep_one(spark.createDataFrame(order, "doc_id long, text string")).collect()
        assert sorted(((r.doc_id, r.text.lower()) for r in got), key=repr) == sorted([(3, a), (8, b), (None, "x y z"), (None, "no id " + b[::-1])], key=repr)
