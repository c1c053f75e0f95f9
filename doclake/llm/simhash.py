"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A fingerprint is cut into three segments, each a word of the perfect Golay code of 23 bits (filled
up with zeros). A word is within 3 bits of exactly one codeword; the codewords within 4 bits are one
or six. Two facts about these make keys of them:
  - words that differ in at most 2 bits have a codeword within 4 bits in common;
  - if they differ in at most 1, the nearest codeword of either is within 4 bits of the other.
Of 4 differing bits, the two segments with the fewest have 2 at most together (pigeonhole): one of
them is equal and the other within 2 bits, or both are within 1. So each ordered pair of segments
gives the keys (first as it is, codewords of the second), and each unordered pair the keys
(codewords of the first, codewords of the second), of which only those need comparing where one
side has its nearest codewords. Fingerprints that share a key are compared in full.

Equal fingerprints are one row throughout. A bucket of a key gives at most as many links as it has
rows: what is already connected inside the bucket is not linked again. Buckets beyond a bound are
cut into blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, permutations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, column
from doclake.llm.components import connected, first_of_each
from doclake.sources.workspace import materialize

SHINGLE = 4
SEED = 42
MOST_BITS = 4

# Lowest bit and length of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
LENGTH, INFORMATION = 23, 12
# Fixed value: a generator polynomial of the Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101

# Rows of a bucket that one task compares; a larger bucket is cut into blocks of about half of it.
BUCKET = 1 << 17
# Buckets up to this size are compared all at once, row by row shifted.
SMALL = 16


# ---- fingerprints


def shingles_of(text: str, shingle: int) -> list[bytes]:
    """The runs of ``shingle`` words, lower-cased; all words if there are fewer, none without words."""
    words = text.encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [joined]
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    return [joined[a : b - 1] for a, b in zip(starts, starts[shingle:], strict=False)]


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of word shingles, 0 without words."""
    shingles = shingles_of(text, SHINGLE)
    if not shingles:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        part = shingles[at : at + (1 << 16)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), "<u8", len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "simhash"
) -> DataFrame:
    """Adds ``name``, the 64 bits of the whole text as a long; null and empty texts have 0.

    Input columns (or ``keep`` of them) are kept, and replaced if so named.
    """

    def start() -> Step:
        def step(values: pa.Array) -> list[pa.Array]:
            found = np.fromiter((fingerprint(v.as_py() or "") for v in values), np.uint64, len(values))
            return [pa.array(found.view(np.int64))]

        return step

    return add_columns(docs, start, f"`{name}` long", [text], keep)


# ---- keys


class Golay:
    """Codewords near a word, as the indices of their information bits."""

    def __init__(self) -> None:
        checks = LENGTH - INFORMATION
        self.syndrome_of = [self._remainder(1 << bit, checks) for bit in range(LENGTH)]
        low, high = np.zeros(1 << 12, np.int32), np.zeros(1 << 11, np.int32)
        for bit, value in enumerate(self.syndrome_of):
            table, place = (low, bit) if bit < 12 else (high, bit - 12)
            table[(np.arange(len(table)) >> place) & 1 == 1] ^= value
        self.low, self.high = low, high
        # Error patterns of weight up to 4 by syndrome: the first is the one to the nearest codeword.
        self.patterns = np.full((1 << checks, 6), -1, np.int64)
        filled = np.zeros(1 << checks, np.int64)
        for weight in range(5):
            for bits in combinations(range(LENGTH), weight):
                syndrome = 0
                for bit in bits:
                    syndrome ^= self.syndrome_of[bit]
                self.patterns[syndrome, filled[syndrome]] = sum(1 << bit for bit in bits)
                filled[syndrome] += 1

    @staticmethod
    def _remainder(word: int, checks: int) -> int:
        for bit in range(LENGTH - 1, checks - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - checks)
        return word

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices (n, 6) of the codewords within 4 bits, nearest first, and which are there."""
        words = words.astype(np.int64)
        patterns = self.patterns[self.low[words & 0xFFF] ^ self.high[words >> 12]]
        return (words[:, None] ^ patterns) >> (LENGTH - INFORMATION), patterns >= 0


class Keys:
    """The keys of fingerprints. A key's lowest bit says whether it is of nearest codewords only."""

    def __init__(self) -> None:
        self.golay = Golay()

    def step(self, column: pa.Array) -> list[pa.Array]:
        prints = column.to_numpy(zero_copy_only=False).view(np.uint64)
        words = [(prints >> np.uint64(low)) & np.uint64((1 << length) - 1) for low, length in SEGMENTS]
        near = [self.golay.near(w) for w in words]
        keys, there = [], []
        number = 0
        for first, second in permutations(range(3), 2):
            index, real = near[second]
            head = (number << 34) | (words[first].astype(np.int64) << 12)
            # In these buckets every row is compared with every other.
            keys.append(((head[:, None] | index) << 1) | 1)
            there.append(real)
            number += 1
        for first, second in combinations(range(3), 2):
            (left, left_real), (right, right_real) = near[first], near[second]
            both = (number << 34) | (left[:, :, None] << 12) | right[:, None, :]
            own = np.zeros(both.shape, np.int64)
            own[:, 0, 0] = 1
            keys.append(((both << 1) | own).reshape(len(prints), -1))
            there.append((left_real[:, :, None] & right_real[:, None, :]).reshape(len(prints), -1))
            number += 1
        values, real = np.concatenate(keys, axis=1), np.concatenate(there, axis=1)
        offsets = np.r_[0, np.cumsum(real.sum(axis=1))].astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[real]))]


# ---- buckets


def _close(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right) <= MOST_BITS


def small_links(bucket: np.ndarray, prints: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links in sorted runs of up to SMALL rows: each row with the next, the one after that, ..."""
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for shift in range(1, min(SMALL, len(bucket))):
        same = (bucket[shift:] == bucket[:-shift]) & (own[shift:] | own[:-shift])
        if not same.any():
            continue
        at = np.flatnonzero(same)
        at = at[_close(prints[at], prints[at + shift])]
        left.append(prints[at])
        right.append(prints[at + shift])
    return np.concatenate(left), np.concatenate(right)


def large_links(prints: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links of one bucket: a row is compared with what it isn't joined to."""
    label = np.arange(len(prints))
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for row in np.flatnonzero(own).tolist():
        others = np.flatnonzero(label != label[row])
        if not len(others):
            break
        hits = others[_close(prints[others], prints[row])]
        if len(hits):
            labels, first = np.unique(label[hits], return_index=True)
            left.append(np.full(len(first), prints[row]))
            right.append(prints[hits[first]])
            label[np.isin(label, labels)] = label[row]
    return np.concatenate(left), np.concatenate(right)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the buckets in a sorted stream; a bucket may go over several batches."""
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush(end: bool) -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        bucket, block, prints = (np.concatenate(c) for c in zip(*waiting, strict=True))
        waiting.clear()
        own, key = (bucket & 1).astype(bool), bucket >> 1
        change = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        edges = np.r_[0, np.flatnonzero(change) + 1, len(key)]
        if not end:  # the last bucket may go on
            last = edges[-2]
            waiting.append((bucket[last:], block[last:], prints[last:]))
            edges, own, prints = edges[:-1], own[:last], prints[:last]
        sizes = np.diff(edges)
        run = np.repeat(np.arange(len(sizes)), sizes)
        small = sizes[run] <= SMALL if len(sizes) else np.zeros(0, bool)
        found = [small_links(run[small], prints[small], own[small])]
        for at in np.flatnonzero(sizes > SMALL).tolist():
            part = slice(edges[at], edges[at + 1])
            # A row with its nearest codewords stands for itself; the copies of a row are not needed.
            found.append(large_links(prints[part], own[part]))
        left, right = (np.concatenate(c) for c in zip(*found, strict=True))
        pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy().view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64))], names=["a", "b"])

    rows = 0
    for batch in batches:
        waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)))
        rows += batch.num_rows
        if rows >= 1 << 18:
            yield from flush(end=False)
            rows = len(waiting[0][0]) if waiting else 0
    yield from flush(end=True)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between different fingerprints of ``simhash``, enough to connect all that
    differ in at most MOST_BITS bits."""
    keyed = add_columns(prints, lambda: Keys().step, "keys array<long>", ["simhash"], ["simhash"])
    rows = keyed.select("simhash", F.explode("keys").alias("key"))
    # Buckets beyond the bound: at most rows / bucket of them.
    counts = rows.groupBy(F.shiftright("key", 1).alias("large")).count().where(F.col("count") > bucket)
    large = materialize(counts.select("large", F.ceil(F.col("count") / (bucket // 2)).alias("blocks")), "large-buckets")
    cut = rows.join(F.broadcast(large), F.shiftright("key", 1) == F.col("large"), "left")
    mine = F.pmod(F.xxhash64("simhash"), F.col("blocks"))
    # A row meets every block of its bucket, its own included, in the group of the two.
    groups = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.least(mine, other) * F.col("blocks") + F.greatest(mine, other),
    )
    dealt = cut.select("key", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(groups)).alias("block"), "simhash")
    placed = dealt.repartition(F.shiftright("key", 1), "block").sortWithinPartitions(F.shiftright("key", 1), "block")
    return placed.mapInArrow(_links, "a long, b long")


def _rooted(distinct: DataFrame) -> DataFrame:
    """Distinct fingerprints with ``root``, the least fingerprint of their component."""
    joined = materialize(links(distinct.select("simhash")).distinct(), "simhash-links")
    roots = connected(joined).withColumnRenamed("node", "simhash")
    return distinct.join(roots, "simhash", "left").withColumn("root", F.coalesce("root", "simhash"))


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``simhash`` and ``component_id``.

    Documents are linked if their fingerprints differ in at most MOST_BITS bits; component_id is
    the smallest id that links lead to, the document's own included. Documents without words share
    fingerprint 0 and are linked like any other. A null id is never the smallest; where no document
    of a component has an id, component_id is null. Repeated rows are rows. Other columns are not
    read. An empty table gives no rows.
    """
    slim = materialize(fingerprints(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), "text", ["doc_id"]), "fingerprints")
    distinct = materialize(slim.groupBy("simhash").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    rooted = _rooted(distinct)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("simhash", "component_id")
    return slim.join(named, "simhash").select(F.col("doc_id").alias(doc_id), "simhash", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, see ``first_of_each``."""

    def grouping(rows: DataFrame) -> DataFrame:
        slim = materialize(fingerprints(rows, "text", ["row"]), "fingerprints")
        rooted = _rooted(materialize(slim.select("simhash").distinct(), "distinct-fingerprints"))
        return slim.join(rooted, "simhash").select("row", F.col("root").alias("component"))

    return first_of_each(docs, grouping, doc_id, text)
