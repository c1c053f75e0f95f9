"""Language id, quality, token counts and language-model scores on planted and odd rows."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from doclake.llm import langid, lm, quality, queries, token_counts
from doclake.llm.common import held_out, table

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "123 !!!", "é", "x" * 3000, "a b " * 40000, "日本語", "\x00 \x1c \x85 a"]


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def odd_docs(spark, extra="lang_score string"):
    rows = [(i, t, "en" if i % 2 else None, "src", "kept") for i, t in enumerate(ODD)] + [(0, "twice", "en", "src", "kept")] * 2 + [(None, "no id", "en", None, None)]
    return rows, spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {extra}")


def test_held_out(spark):
    frame = spark.createDataFrame([(i,) for i in [*range(50), -7, 10**15, None]], "doc_id long")
    got = [r.h for r in frame.select(held_out(F.col("doc_id"), 7, 2).alias("h")).collect()]
    assert got == [fold(i, 7) == 2 for i in [*range(50), -7, 10**15]] + [False]


# ---- language id


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in table(spark, DATA, "documents").collect()}
    rows = queries.op9_language_id(spark, DATA).collect()
    assert len(rows) == len(docs)
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert len(right) > 200 and np.mean(right) > 0.97
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    rows, docs = odd_docs(spark)
    dictionaries = {"de": "der die das und ist nicht mit ".encode() * 20, "en": b"the of and that with this was " * 20}
    judged = langid.identify(docs, dictionaries)
    assert judged.columns == ["doc_id", "text", "lang", "source", "lang_pred", "lang_score", "lang_narrow"]
    got = judged.collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert r.lang_narrow or letters
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(docs.limit(0), dictionaries).count() == 0
    assert langid.learn(docs.limit(0)) == {}


def test_language_by_whole_text_and_smallest_size():
    sizer = langid.Sizer({"a": b"alpha beta gamma delta " * 30, "b": b"uno due tre quattro cinque " * 30})
    late = "x " * langid.BLOCK + "uno due tre quattro cinque " * 20
    assert sizer.predict(late)[0] == "b"
    assert sizer.sizes(late.encode()) == [sum(len(c(late.encode()[i : i + langid.BLOCK])) for i in range(0, len(late), langid.BLOCK)) for c in sizer.whole]
    assert sizer.predict("zq")[1] <= 0.6


def test_dictionaries_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS", 5)
    monkeypatch.setattr(langid, "CHARS", 20)
    found = langid.learn(table(spark, SMALL, "documents"))
    assert set(found) == {"en", "de", "fr", "es"} and all(0 < len(d) <= 5 * 62 for d in found.values())


# ---- quality


def rank_auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    positive = np.array(labels) == 1
    return (ranks[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / (positive.sum() * (~positive).sum())


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in table(spark, DATA, "labels").collect()}
    rows = queries.op8_quality_scores(spark, DATA).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert rank_auc([s for s, _, _ in judged], [q for _, q, _ in judged]) > 0.95
    clean = [p for _, q, p in judged if q == 1]
    assert np.mean(clean) > 0.97


def test_prior_is_found():
    rng = np.random.default_rng(0)
    positive, unlabelled = rng.normal(2, 1, 4000), np.r_[rng.normal(2, 1, 3000), rng.normal(-3, 1, 1000)]
    assert quality.estimate_prior(positive, unlabelled) == pytest.approx(0.75, abs=0.04)


def test_risk_against_brute_force():
    """The fitted weights lower the non-negative risk, summed up row by row."""
    rng = np.random.default_rng(3)
    raw = np.abs(rng.normal(0.2, 0.05, (220, quality.RAW))).astype(np.float32)
    raw[160:, -2] += 3
    positive, unlabelled = raw[:80], raw[80:]
    model = quality.fit(positive, unlabelled)

    def risk(weights, bias):
        total = {True: 0.0, False: 0.0}
        for rows, sign in ((positive, 1), (positive, -1), (unlabelled, -1)):
            spans = model.span.features(rows)
            z = np.clip((spans - model.mean) / model.scale, -quality.CLIP, quality.CLIP) @ weights + bias
            loss = np.mean([math.log1p(math.exp(-sign * float(v))) for v in z])
            if sign == 1:
                total[True] += model.prior * loss
            else:
                total[False] += loss if rows is unlabelled else -model.prior * loss
        return total[True] + max(0.0, total[False]) + quality.PENALTY / 2 * float(weights @ weights)

    begin = risk(np.zeros(len(model.weights)), math.log(model.prior / (1 - model.prior)))
    assert risk(model.weights, model.bias) < 0.3 * begin


def test_a_hot_id_does_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "UNLABELLED", 40)
    monkeypatch.setattr(quality, "POSITIVES", 40)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u: seen.append((p.shape, u.shape)))
    docs = [(7, f"text {i} of the same id") for i in range(3000)] + [(7, "copy")] * 2000 + [(i, f"text {i}") for i in range(100, 130)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    quality.learn(frame, spark.createDataFrame([(7,), (101,), (None,)], "doc_id long"))
    (positives, unlabelled), = seen
    assert positives == (40, quality.RAW) and 20 <= unlabelled[0] <= 40


def test_quality_of_odd_texts(spark):
    rows, docs = odd_docs(spark, "quality_score string")
    model = quality.learn(docs, docs.where("lang = 'en'"))
    scored = quality.score(docs, model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "quality_score"]
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.quality_score <= 1 for r in got)
    empty = {r.quality_score for r in got if not r.text}
    assert len(empty) == 1
    untrained = quality.learn(docs.limit(0), docs.limit(0))
    assert {r.quality_score for r in quality.score(docs, untrained).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


# ---- token counts


@pytest.fixture(scope="module")
def counter():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return token_counts.Counter(file.read(), chunk=60, overlap=8)


MARKED = "Tail<|endoftext|>of <|startoftext|> a<|endoftext|>b İSTANBUL ΣΑΣ ñandú ñ don't we'll 2024-01-02 日本語テスト " + " " + "end of line "


def test_counts_of_chunks_equal_the_whole(counter):
    rng = np.random.default_rng(4)
    pieces = ["word ", "the ", "longerwordwithoutspace" * 6, " ", "\n", "é́ ", "12 ", "!!", MARKED, "<|endoftext|>" * 9]
    for _ in range(60):
        text = "".join(rng.choice(pieces, rng.integers(1, 40)))
        assert counter.long(text) == len(counter.tokenizer.encode(text, add_special_tokens=False))
    assert counter.widened > 0
    for text in ("", "x" * 1000, " " * 1000, "ab " * 500, "word" * 40 + " " + "x" * 200):
        assert counter.long(text) == len(counter.tokenizer.encode(text, add_special_tokens=False))


def test_token_counts(spark, counter):
    docs = [*ODD, MARKED, MARKED * 2000, "no spaces" * 9000]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)] + [(None, "word", "x")] * 2, "doc_id long, text string, N_Tokens string")
    counted = token_counts.count_tokens(frame, public_tokenizers.path("word_bpe_49k.json"))
    assert counted.columns == ["doc_id", "text", "n_bytes", "n_tokens"]
    got = counted.collect()
    assert len(got) == len(docs) + 2
    for r in got:
        assert r.n_bytes == len((r.text or "").encode())
        assert r.n_tokens == len(counter.tokenizer.encode(r.text or "", add_special_tokens=False))
    assert token_counts.count_tokens(frame.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_registered_token_counts(spark, counter):
    rows = {r.doc_id: r for r in queries.op6_token_counts(spark, SMALL).collect()}
    for doc in table(spark, SMALL, "documents").collect():
        n = len(counter.tokenizer.encode(doc.text, add_special_tokens=False))
        assert (rows[doc.doc_id].n_tokens, rows[doc.doc_id].over_limit) == (n, n > 2048)


# ---- language model


def brute_base(docs, fold_of):
    counts, n = Counter(), 0
    lines = {i: (t or "").encode().lower().split() for i, t in docs.items()}
    for i, words in lines.items():
        if fold_of(i) != 2:
            counts.update([*words, b" end"])
            n += len(words) + 1
    out = {}
    for i, words in lines.items():
        unit = n + len(counts) + 1
        out[i] = (len(words) + 1, sum(counts[w] > 0 for w in [*words, b" end"]), sum(math.log10((counts[w] + 1) / unit) for w in [*words, b" end"]), n)
    return out


def test_language_model_scores(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3000)
    docs = {r.doc_id: r.text for r in table(spark, DATA, "documents").collect()}
    want = brute_base(docs, lambda i: fold(i, 7))
    rows = queries.op2_lm_scores(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (want[r.doc_id][0], want[r.doc_id][1], want[r.doc_id][3], fold(r.doc_id, 7) == 2)
        assert r.base_score == pytest.approx(want[r.doc_id][2], rel=1e-9)
    held = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    # Context tells more than counts alone: at least 0.05 in log10 a token.
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.05


def test_model_is_normalised():
    vocabulary = lm.Vocabulary(100, 9, 5, [b"a", b"b"], np.array([30, 20]), [b"ing", b"ed"], np.array([20, 10, 15]), np.array([3, 2, 2]))
    rng = np.random.default_rng(0)
    size = vocabulary.classes
    model = lm.Model(*[rng.normal(0, 1, s) for s in ((size, 4), (size, 4), (4, 4), (4, 4), (size,))])
    near, far, total = model.tables()
    for one in range(size):
        for two in range(size):
            logs = near[one] + far[two] - total[two, one]
            assert np.exp(np.delete(logs, lm.BEGIN)).sum() == pytest.approx(1)
    # The gradient is that of the noise-contrastive likelihood.
    noise = lm.unigram(vocabulary)
    one, two, counts = np.array([2, 1, 2]), np.array([0, 3, 2]), rng.integers(0, 9, (3, size)).astype(float)
    counts[:, lm.BEGIN] = 0

    def likelihood(flat):
        m = model.unpack(flat)
        odds = m.predict(one, two) @ m.target.T + m.bias - np.log(lm.NOISE * noise)
        expected = counts.sum(axis=1, keepdims=True) * lm.NOISE * noise * np.logaddexp(0, odds)
        expected[:, lm.BEGIN] = 0
        return (-counts * np.logaddexp(0, -odds) - expected).sum()

    flat, made = model.pack(), lm._gradient(model, noise, one, two, counts)
    for at in rng.choice(len(flat), 40, replace=False):
        step = np.zeros(len(flat))
        step[at] = 1e-5
        assert made[at] == pytest.approx((likelihood(flat + step) - likelihood(flat - step)) / 2e-5, rel=1e-3, abs=1e-4)


def test_language_model_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 4)
    monkeypatch.setattr(lm, "WORDS", 2)
    monkeypatch.setattr(lm, "SUFFIXES", 2)
    monkeypatch.setattr(lm, "ROUNDS", 2)
    rows, docs = odd_docs(spark, "score string")
    got = lm.score(docs, F.col("lang").isNull()).collect()
    assert len(got) == len(rows)
    assert all(r.score <= 0 and math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert all(r.n_tokens == len((text or "").encode().split()) + 1 for r, text in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)), [None, "twice", "twice", *ODD[1:], "no id"], strict=True))
    untrained = lm.score(docs, F.lit(None).cast("boolean")).collect()
    assert {(r.train_tokens, r.n_known, r.held_out) for r in untrained} == {(0, 0, True)}
    assert lm.score(docs.limit(0), F.lit(False)).count() == 0
