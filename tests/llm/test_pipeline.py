"""The stages, each against a brute-force version of what it keeps."""

from __future__ import annotations

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_simhash import brute_components, brute_fingerprint

import __spark_entry__ as entry
from doclake.llm import bpe, langid, mixing
from doclake.llm.common import held_out, table

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The documents, and what each stage returns of what its predecessor wrote."""
    out, docs = [table(spark, DATA, "documents")], table(spark, DATA, "documents")
    for at, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(at))
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(kept):
    assert all(frame.columns == kept[0].columns for frame in kept[:-1])


def test_language_stage(spark, kept):
    docs = kept[0]
    sizer = langid.Sizer(langid.learn(docs.where(~held_out(F.col("doc_id"), 4, 2))))
    want = {r.doc_id for r in docs.collect() if not sizer.predict(r.text or "")[2]}
    assert {r.doc_id for r in kept[1].collect()} == want
    assert len(want) >= 0.99 * docs.count()


def test_quality_stage(spark, kept):
    labels = {r.doc_id: r.quality for r in table(spark, DATA, "labels").collect()}
    before, after = ({r.doc_id for r in frame.collect()} for frame in kept[1:3])
    assert after <= before
    good, bad = ({i for i in before if labels.get(i) == q} for q in (1, 0))
    assert len(good & after) >= 0.95 * len(good) and len(bad & after) <= 0.4 * len(bad)


def test_dedup_stage(kept):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in kept[2].collect()}
    component = brute_components(dict(sorted(prints.items())))
    assert sorted(r.doc_id for r in kept[3].collect()) == sorted({*component.values()})


def test_mixing_stage(kept):
    slim = mixing.sizes(kept[3])
    planned = {r.doc_id: r for r in mixing.plan(slim, mixing.targets(slim)).collect()}
    copies = {}
    for r in kept[4].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for i, r in planned.items():
        assert copies.get(i, 0) == sum(c.words * 2 >= r["size"] for c in r.copies)


def test_encoding_stage(kept):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    rows = kept[5].collect()
    assert len(rows) == kept[4].count()
    for r in rows:
        assert r.round_trip and r.ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_stages_take_nulls_and_no_rows(spark):
    docs = table(spark, DATA, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, None, 0), (10**9 + 1, "7", "en", "x", None)], docs.schema)
    for name, stage in pipeline.STAGES:
        whole = docs.limit(30).union(odd)
        assert stage(spark, whole, DATA).count() > 0, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is pipeline.run
    assert pipeline.run(spark, DATA).count() > 0
