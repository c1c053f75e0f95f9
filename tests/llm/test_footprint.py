"""What the operators leave on disk and hold in the driver."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from doclake.llm import components, mixing, quality


def _prose(rows: int) -> list[tuple[int, str, str]]:
    deal = random.Random(5)
    words = ["".join(deal.choices("aehinorst", k=deal.randint(2, 9))) for _ in range(400)]
    return [(i, f"source {i % 3}", " ".join(deal.choices(words, k=300))) for i in range(rows)]


def _text_codec(folder: Path) -> set[str]:
    files = [pq.ParquetFile(path).metadata for path in folder.glob("*.parquet")]
    groups = [each.row_group(g) for each in files for g in range(each.num_row_groups)]
    columns = [group.column(c) for group in groups for c in range(group.num_columns)]
    return {c.compression for c in columns if c.path_in_schema == "text"}


def test_rows_with_whole_texts_are_kept_small(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.glob("keyed-rows-*"))
    docs = spark.createDataFrame(_prose(200), "doc_id long, source string, text string")
    assert mixing.mix(docs).count() >= 200
    kept = components.first_of_each(docs, lambda rows: rows.selectExpr("row", "row % 50 AS component"), "doc_id", "text")
    assert kept.count() >= 50
    assert [_text_codec(each) for each in set(root.glob("keyed-rows-*")) - before] == [{"ZSTD"}] * 2


def test_samples_come_to_the_driver_packed(spark, monkeypatch):
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *samples: seen.append(samples) or fit(*samples))
    docs = spark.createDataFrame(_prose(120), "doc_id long, source string, text string")
    model = quality.learn(docs, docs.where("doc_id % 2 = 0").select("doc_id"))
    (positive, unlabelled), = seen
    assert positive.shape == (60, quality.RAW) and unlabelled.shape == (120, quality.RAW)
    assert sum(map(len, unlabelled.rows)) < 120 * quality.RAW * 4 / 8
    plain = fit(positive[:], unlabelled[:])
    assert plain.prior == model.prior and np.array_equal(plain.weights, model.weights)
    reader = quality.Reader()
    raw = {row.tobytes() for row in np.stack([reader.features(text.encode()) for _, _, text in _prose(120)])}
    assert {row.tobytes() for row in unlabelled[:]} == raw


def test_spread_by_columns_is_that_of_the_whole():
    matrix = np.random.default_rng(2).normal(1, 3, (700, quality.RAW)).astype(np.float32)
    assert np.array_equal(quality.Span.of(matrix).spread, matrix.std(axis=0) + np.float32(1e-3))
