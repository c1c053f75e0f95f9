"""Importance resampling towards a target corpus, by hashed n-gram features.

A 256-byte table lower-cases A-Z and blanks every other ASCII byte that is no letter or digit, so
``bytes.split`` yields the words of a text in UTF-8. A feature is a run of words joined by one
space; its checksum is that of the shorter run, continued (``zlib.crc32`` takes the checksum so far
as its seed), modulo the number of buckets. Counters reduce a slice of texts to its distinct words
first, a task to one count per bucket, and Spark sums the tasks.

A bucket's gain says how much more frequent it is in the target, with one pseudo count per bucket; a
document's weight is the sum of the gains of its features. Adding Gumbel noise, a function of the
id alone, makes the highest scores a sample without replacement in proportion to exp(weight/1000).

Driver and tasks hold one number per bucket, whatever the input. The ranking is a range sort: no
task sees more than its range.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, column, slices
from doclake.sources.workspace import materialize

BUCKETS = 10000
LEAST_WORDS = 20
SHARE = 10

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
TABLE = bytes(c if c in _KEPT or c >= 0x80 else ord(" ") for c in (c + 32 if 65 <= c <= 90 else c for c in range(256)))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TABLE).split()


def features_of(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """Bucket of every run of 1 to ``longest`` words, repeats included."""
    first = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    found, seeds = [first], first.tolist()
    for more in range(1, min(longest, len(words))):
        seeds = [zlib.crc32(b" " + word, seed) for word, seed in zip(words[more:], seeds, strict=False)]
        found.append(np.array(seeds, np.int64))
    return np.concatenate(found) % buckets


def bucket_counts(rows: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket. Null and empty texts have none; no rows give zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            if longest > 1:
                for value in batch.column(0):
                    np.add.at(total, features_of(words_of(value.as_py()), longest, buckets), 1)
                continue
            counter: Counter[bytes] = Counter()
            for value in batch.column(0):
                counter.update(words_of(value.as_py()))
            at = features_of(list(counter), 1, buckets)
            np.add.at(total, at, np.fromiter(counter.values(), np.int64, len(counter)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = rows.select(column(text).alias("text")).mapInArrow(run, "bucket long, n long")
    # At most one row per bucket comes to the driver.
    summed = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for row in summed:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share, per bucket, rounded down."""
    all_source, all_target, buckets = float(source.sum()), float(target.sum()), len(source)
    ratio = (target + 1.0) * (all_source + buckets) / ((source + 1.0) * (all_target + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(
    docs: DataFrame, gain: np.ndarray, text: str = "text", longest: int = 1, keep: list[str] | None = None
) -> DataFrame:
    """Adds ``n_words``, ``n_features`` and ``weight``. A text without words has zeros."""

    def start() -> Step:
        def step(values: pa.Array) -> list[pa.Array]:
            out = np.zeros((3, len(values)), np.int64)
            for at, value in enumerate(values):
                words = words_of(value.as_py())
                if words:
                    found = features_of(words, longest, len(gain))
                    out[:, at] = len(words), len(found), gain[found].sum()
            return [pa.array(each) for each in out]

        return step

    return add_columns(docs, start, "n_words long, n_features long, weight long", [text], keep)


def noise(doc_id: Column, seed: str) -> Column:
    """Thousandths of a Gumbel number that the id decides, rounded down; a null id counts as empty text."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Adds ``rank`` from 1 in the order: a range sort, and one row per range to add up."""
    placed = materialize(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_within": within})
    before = F.sum("rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition of the sort, so the broadcast is bounded by a setting.
    starts = placed.groupBy("_part").agg(F.count("*").alias("rows")).select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    ranked = placed.join(F.broadcast(starts), "_part").withColumn("rank", F.col("_start") + F.col("_within") + 1)
    return ranked.drop("_at", "_part", "_within", "_start")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: str = "2024",
    longest: int = 1,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    share: int = SHARE,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (of the drawn ones, else null).

    Documents of at least ``least_words`` words compete; ``share`` percent of them, rounded down,
    are drawn, highest scores first, ties to the smaller id, a null id last, then the smaller weight
    and fewer features, so that rows that still tie are equal. Null and empty texts have no features,
    weight 0 and are never drawn; a null id counts as empty text in the noise. Repeated rows are
    rows. Other columns are not read. Without documents there are no rows; without target texts the
    target is even over the buckets.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    slim = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    weighed = weigh(slim, gain, "text", longest, ["doc_id"])
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    competing = F.col("n_words") >= least_words
    drawn = scored.where(competing).count() * share // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    ranked = numbered(scored.where(competing).select(*columns), *order)
    first = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(~competing).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, first.cast("long").alias("rank")).union(rest).withColumnRenamed("doc_id", doc_id)
