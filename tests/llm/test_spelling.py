"""Spelling variants against brute force on planted and random words."""

from __future__ import annotations

import random
import re
import zlib

import pytest

from doclake.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(docs):
    counts = {}
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    words = brute_words(docs)
    form, out = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(((-words[x], x) for x in near), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n else None
        out[w] = [n, len(near), words[form[w]] if form[w] else None]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, *out[w])
    return sorted(out.values(), key=repr)


def found(spark, docs, ddl="doc_id long, text string"):
    rows = spelling.variants(spark.createDataFrame(docs, ddl)).collect()
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows), key=repr)


def test_random_words(spark):
    dice = random.Random(5)
    words = ["".join(dice.choice("aabcé÷À") for _ in range(dice.randint(4, 9))) for _ in range(120)]
    words += [w[:i] + c + w[i + d :] for w in words for i, c, d in [(dice.randrange(len(w) + 1), dice.choice(["", "a", "Z"]), dice.randint(0, 1))]]
    docs = [(i, " ".join(dice.choices(words, weights=[1 / (1 + k % 40) for k in range(len(words))], k=60))) for i in range(80)]
    want = brute(docs)
    assert found(spark, docs) == want
    assert sum(r[1] is not None for r in want) > 10 and any(r[2] != (r[1] or r[0]) for r in want)


def test_edits_everywhere(spark):
    base = "abcdefghij"
    near = {base[:i] + "x" + base[i:] for i in range(11)} | {base[:i] + base[i + 1 :] for i in range(10)} | {base[:i] + "y" + base[i + 1 :] for i in range(10)}
    docs = [(1, " ".join([base] * 40)), (2, " ".join(w for w in sorted(near) for _ in range(4)))]
    assert found(spark, docs) == brute(docs)


def test_long_and_repeated_letters(spark):
    long = "ab" * 3000
    texts = [f"{long} {long}c {'a' * 30} {'a' * 31} {'a' * 32} aaaaa aaaaaa" for _ in range(4)]
    docs = list(enumerate(texts))
    assert found(spark, docs) == brute(docs)


def test_nulls_repeats_and_nothing(spark):
    docs = [(None, "Straße straße STRASSE"), (None, "straße strasse"), (1, None), (2, ""), (3, "strasse 123 ____"), (3, "strasse 123 ____"), (4, "straße")]
    assert found(spark, docs) == brute(docs)
    assert found(spark, []) == [] and found(spark, [(1, "one two three")]) == []


@pytest.mark.parametrize("share", [3])
def test_a_third_of_the_words_share_a_prefix(spark, share):
    dice = random.Random(6)
    words = ["commonprefix" + "".join(dice.choice("abc") for _ in range(5)) for _ in range(60)]
    words += ["".join(dice.choice("abcdefgh") for _ in range(7)) for _ in range(60 * (share - 1))]
    docs = [(i, " ".join(words)) for i in range(3)] + [(9, " ".join(words[::5]))]
    assert found(spark, docs) == brute(docs)
