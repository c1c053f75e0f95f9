"""Texts in unlearned languages and junk are rejected, clean documents stay."""

from __future__ import annotations

import random
import string

import pytest
from pyspark.sql import functions as F

from doclake.llm import langid
from doclake.llm.common import held_out, table

DATA = "/root/testdata/sf0.01"


def junk(n):
    rng = random.Random(n)
    return [" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(words)) for words in (20, 60, 300) for _ in range(n)]


def rejected(spark, texts, learned):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return sum(r.lang_narrow for r in langid.identify(frame, learned).collect()) / len(texts)


@pytest.mark.parametrize("unlearned", [["de"], ["fr"], ["de", "es", "fr"]])
def test_unlearned_languages_and_junk_go(spark, unlearned):
    docs = table(spark, DATA, "documents")
    held = held_out(F.col("doc_id"), 4, 2)
    learned = langid.learn(docs.where(~held & ~F.col("lang").isin(unlearned)))
    long = docs.where(F.length("text") >= 256)
    clean, foreign = ([r.text for r in long.where(w).collect()] for w in (held & ~F.col("lang").isin(unlearned), F.col("lang").isin(unlearned)))
    got = rejected(spark, clean, learned), rejected(spark, foreign, learned), rejected(spark, junk(40), learned)
    print(unlearned, learned.limits, got)
    assert got[0] <= 0.02 and got[1] >= 0.95 and got[2] >= 0.9
