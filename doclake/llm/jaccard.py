"""Documents whose sets of word shingles have a Jaccard similarity of 0.8 or more, by parity sketches.

The shingles of a set are dealt to segments by their hash, and the hashes in a segment are combined
by XOR. Two sets that differ in d shingles differ in at most d segments: so of more than d segments
that a set fills, one is the same in both (pigeonhole), and its XOR is a key that they share. Sets
of a size from s to 1.25 s that are similar enough differ in at most a quarter of the smaller size;
so a band of sizes has a bound for d, and segments enough to exceed it. A set takes part in its
own band and, as the larger one of a pair, in the band below. Where chance leaves a set with too
few filled segments, every shingle gets a segment of its own, once more: then there are enough.
A pair is found if one of the two has enough, as the segment then is filled in both.

With the keys goes a sketch of one bit per shingle hash, XORed. Its Hamming distance is at most the
number of shingles in which the sets differ: a pair whose distance is too great needs no comparison.

Keys that only one set has are dropped in the shuffle. The rest is compared in two rounds, so that a
group of thousands of near copies does not make pairs of all its members:
  - every set meets the leaders of each of its keys; the links that hold give components;
  - only keys that still hold several components are compared in full, and of their pairs only those
    that cross components and pass the sketch.
Every pair is decided by its sets themselves, so what is left out is already connected.

Sets and shingles are known by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, column
from doclake.llm.components import connected
from doclake.sources.workspace import materialize

SHINGLE = 5
# Sets are similar if 100 * intersection >= LEAST * union. The bound of a band is derived for 80.
LEAST = 80
# The sizes of a band go up by this factor: the largest ratio of sizes that are similar enough.
RATIO = 100 / LEAST
# A hot key's rows beyond so many in one batch need not meet in one task to be known as shared.
SPREAD = 4
# Rows of a key that one task compares; a larger bucket is cut into blocks of about half of it.
BUCKET = 1 << 15
# Pairs of a key with more rows than this are looked for in other such keys, to be made only once.
CROWD = 16
# Keys by which a set is compared with others for that: the least of as many residue classes.
MARKS = 8
# Bits of the filter that picks the texts of candidate sets; false hits cost work only.
FILTER_BITS = 1 << 20

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # fixed values: a public 64-bit mixer
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- sets


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``shingle`` words (A-Z lower-cased); with fewer words one
    of all of them; none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = min(shingle, len(words))
    rows = len(words) - run + 1
    total = np.full(rows, run, np.uint64)
    for at in range(run):
        total = _mixed(total * _ODD + hashes[at : at + rows])
    return np.unique(total)


def band_of(size: int) -> int:
    """The band with RATIO ** band <= size < RATIO ** (band + 1)."""
    band = int(np.log(size) / np.log(RATIO))
    while size >= RATIO ** (band + 1):
        band += 1
    while size < RATIO**band:
        band -= 1
    return band


def most_apart(band: int) -> int:
    """How many shingles a set of the band and a similar one, not smaller, can differ in at most."""
    return int(np.ceil(RATIO ** (band + 1))) // 4


def segments(band: int) -> int:
    """Segments of a band: enough over the bound for those that chance leaves empty."""
    bound = most_apart(band)
    return bound + 1 + (int(0.1 * bound) + 3 if bound else 0)


def segment_keys(shingles: np.ndarray, band: int) -> np.ndarray:
    """Keys of a set in a band: the XOR of every filled segment, and if those are too few to exceed
    the bound, every shingle for itself."""
    count = segments(band)
    spread = _mixed(shingles ^ np.uint64(band + 1))
    at = (spread % np.uint64(count)).astype(np.int64)
    combined = np.zeros(count, np.uint64)
    np.bitwise_xor.at(combined, at, spread)
    filled = np.unique(at)
    keys = _mixed(combined[filled] + _ODD * (filled.astype(np.uint64) + np.uint64(1)))
    if len(filled) > most_apart(band):
        return keys
    return np.concatenate([keys, _mixed(spread + _ODD)])


def sketch_bits(band: int) -> int:
    """A power of two from the sizes of the band on, and 128 at least."""
    return max(128, 1 << int(np.ceil(RATIO ** (band + 1)) - 1).bit_length())


def sketch_of(shingles: np.ndarray, bits: int) -> bytes:
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(sketch: np.ndarray, length: int) -> np.ndarray:
    """A sketch as one of ``length`` bytes: bits that fall together are XORed."""
    while len(sketch) > length:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def distance(left: np.ndarray, right: np.ndarray) -> int:
    """Hamming distance of two sketches, at most the number of shingles the sets differ in."""
    length = min(len(left), len(right))
    return int(np.bitwise_count(fold(left, length) ^ fold(right, length)).sum())


def may_link(left_size: int, right_size: int, apart: int) -> bool:
    """Whether sets that differ in ``apart`` shingles or more can be similar enough: the union of
    such sets is (left + right + apart) / 2."""
    return 100 * (left_size + right_size - apart) >= LEAST * (left_size + right_size + apart)


def sets(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n, set_id, sketch, keys`` of ``doc_id, text``. An empty set has id 0."""

    def start() -> Step:
        def step(values: pa.Array) -> list[pa.Array]:
            sizes, ids, sketches, keys = [], [], [], []
            for value in values:
                found = shingle_set(value.as_py())
                sizes.append(len(found))
                if not len(found):
                    ids.append(0), sketches.append(b""), keys.append(b"")
                    continue
                ids.append(xxhash.xxh3_64_intdigest(found.tobytes()))
                band = band_of(len(found))
                sketches.append(sketch_of(found, sketch_bits(band)))
                both = [segment_keys(found, each) for each in (band, band - 1) if each >= 0]
                keys.append(np.unique(np.concatenate(both)).tobytes())
            return [
                pa.array(sizes, pa.int64()),
                pa.array(np.array(ids, np.uint64).view(np.int64)),
                pa.array(sketches, pa.binary()),
                pa.array(keys, pa.binary()),
            ]

        return step

    added = "n long, set_id long, sketch binary, keys binary"
    return add_columns(docs, start, added, ["text"], ["doc_id", "text_key"])


# ---- shared keys


def _spread_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, lane, set_id``: the keys of the batch's distinct sets. Of a key's rows in the batch the
    first few go to lane 0, where all rows of the key meet; the others, which are then known to share
    it, are spread over other lanes."""
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            ids, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            lists = [np.frombuffer(batch.column(1)[int(i)].as_py(), np.uint64) for i in first]
            if not lists:
                continue
            keys = np.concatenate(lists)
            owners = np.repeat(ids, [len(each) for each in lists])
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], owners[order]
            new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            rank = np.arange(len(keys)) - np.repeat(starts, np.diff(np.r_[starts, len(keys)]))
            lane = np.where(rank < SPREAD, 0, 1 + (owners.view(np.uint64) % np.uint64(4096)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(lane.astype(np.int32)), pa.array(owners)], names=["key", "lane", "set_id"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, lane and set: one row per key and set, keys of a single set left out."""
    held: tuple[int, int, int] | None = None  # the last row, if it may still be alone
    last: tuple[int, int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, lane, owner = (c.to_numpy() for c in batch.columns)
        if last is not None:
            key, lane, owner = np.r_[last[0], key], np.r_[last[1], lane], np.r_[last[2], owner]
        same = (key[1:] == key[:-1]) & (lane[1:] == lane[:-1])
        distinct = np.r_[True, ~(same & (owner[1:] == owner[:-1]))]
        key, lane, owner = key[distinct], lane[distinct], owner[distinct]
        joined = (key[1:] == key[:-1]) & (lane[1:] == lane[:-1])
        keep = np.r_[False, joined] | np.r_[joined, False] | (lane > 0)
        if last is not None and held is None:
            keep[0] = False  # it has gone out already
        end = len(key) - 1
        # The last row's company may be in the next batch.
        held = None if keep[end] or (end == 0 and last is not None and held is None) else (key[end], lane[end], owner[end])
        last = (key[end], lane[end], owner[end])
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(owner[keep])], names=["key", "set_id"])


def shared_keys(made: DataFrame) -> DataFrame:
    """``key, set_id`` for the keys that several sets have; a copy of a set is no other set. A row can
    come more than once."""
    rows = made.where("n > 0").select("set_id", "keys").mapInArrow(_spread_keys, "key long, lane int, set_id long")
    dealt = rows.repartition("key", "lane").sortWithinPartitions("key", "lane", "set_id")
    return dealt.mapInArrow(_shared, "key long, set_id long")


# ---- pairs


def _by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, n_a, n_b = (batch.column(i).to_numpy() for i in range(4))
        keep = np.zeros(batch.num_rows, bool)
        for at in range(batch.num_rows):
            left, right = (np.frombuffer(batch.column(c)[at].as_py(), np.uint8) for c in (4, 5))
            keep[at] = may_link(int(n_a[at]), int(n_b[at]), distance(left, right))
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def pass_sketch(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sketches leave the link possible. ``known``: set_id, n, sketch."""
    for side in ("a", "b"):
        renamed = known.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(renamed, side)
    return pairs.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_by_sketch, "a long, b long")


def crossing(members: list[np.ndarray], sizes: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one bucket that cross components and pass the sketch."""
    length = min(map(len, members))
    folded = np.stack([fold(m, length) for m in members])
    folded = folded.view(np.uint64)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(len(sizes) - 1):
        others = at + 1 + np.flatnonzero(component[at + 1 :] != component[at])
        apart = np.bitwise_count(folded[others] ^ folded[at]).sum(axis=1, dtype=np.int64)
        total = sizes[others] + sizes[at]
        hits = others[100 * (total - apart) >= LEAST * (total + apart)]
        left.append(np.full(len(hits), at))
        right.append(hits)
    return np.concatenate(left), np.concatenate(right)


def made_here(key: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of crowded bucket ``key`` to make in it, by the marks of their two sets.

    A mark that both have is the key of a crowded bucket they also meet in. The least of those makes
    the pair, the others leave it out; without one every bucket makes it.
    """
    top = np.iinfo(np.int64).max
    both = np.where((left == right) & (left != top), left, top).min(axis=1)
    return (both == top) | (both == key)


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the buckets in a stream sorted by (key, block)."""
    waiting: list[pa.RecordBatch] = []

    def compared(table: pa.Table) -> np.ndarray:
        ids, component, sizes = (table.column(c).to_numpy() for c in ("set_id", "component", "n"))
        sketches = [np.frombuffer(v.as_py(), np.uint8) for v in table.column("sketch")]
        left, right = crossing(sketches, sizes, component)
        if len(left) and table.column("marks")[0].is_valid:
            marks = np.array(table.column("marks").to_pylist(), np.int64)
            here = made_here(table.column("key")[0].as_py(), marks[left], marks[right])
            left, right = left[here], right[here]
        return np.stack([np.minimum(ids[left], ids[right]), np.maximum(ids[left], ids[right])], axis=1)

    def flush(end: bool) -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        table = pa.Table.from_batches(waiting)
        waiting.clear()
        key, block = table.column("key").to_numpy(), table.column("block").to_numpy()
        edges = np.r_[0, np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1, len(key)]
        if not end:
            waiting.extend(table.slice(int(edges[-2])).to_batches())
            edges = edges[:-1]
        found = [compared(table.slice(int(a), int(b - a))) for a, b in zip(edges, edges[1:], strict=False) if b - a > 1]
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= 1 << 14:
            yield from flush(end=False)
            rows = sum(b.num_rows for b in waiting)
    yield from flush(end=True)


def made_pairs(shared: DataFrame, known: DataFrame, roots: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``crossing_pairs``, some more than once.

    Buckets fold the sketches to their shortest one, so a pair may pass in one and not in another:
    then it is no link, as any folded distance is at most the true one.
    """
    named = shared.join(roots.withColumnsRenamed({"node": "set_id", "root": "component"}), "set_id", "left")
    named = named.withColumn("component", F.coalesce("component", "set_id"))
    named = materialize(named, "shared-components")
    several = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows"))
    blocks = F.when(F.col("rows") > bucket, F.ceil(F.col("rows") / (bucket // 2))).otherwise(1).cast("long")
    several = several.where("low != high").select("key", blocks.alias("blocks"), (F.col("rows") > CROWD).alias("crowded"))
    several = materialize(several, "crossing-keys")
    # Near copies share most of their keys: a pair of them would be made in every bucket of these.
    top = F.lit(np.iinfo(np.int64).max).cast("long")
    least = [F.min(F.when(F.pmod("key", F.lit(MARKS)) == i, F.col("key"))) for i in range(MARKS)]
    crowds = named.join(several.where("crowded"), "key").groupBy("set_id")
    marks = crowds.agg(F.array(*[F.coalesce(each, top) for each in least]).alias("all_marks"))
    rows = named.join(several, "key").join(known, "set_id").join(marks, "set_id", "left")
    rows = rows.withColumn("marks", F.when(F.col("crowded"), F.col("all_marks")))
    mine = F.pmod(F.xxhash64("set_id"), F.col("blocks"))
    # A row meets every block of its bucket, its own included, in the group of the two.
    groups = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.least(mine, other) * F.col("blocks") + F.greatest(mine, other),
    )
    dealt = rows.select("key", F.explode(groups).alias("block"), "set_id", "component", "n", "sketch", "marks")
    placed = dealt.repartition("key", "block").sortWithinPartitions("key", "block")
    return placed.mapInArrow(_bucket_pairs, "a long, b long")


def crossing_pairs(shared: DataFrame, known: DataFrame, roots: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: sets that share a key, lie in different components and pass the sketch."""
    return made_pairs(shared, known, roots, bucket).distinct()


# ---- verification


def _picked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text_key, text`` of the texts whose key is in ``wanted``, each once.

    A bit filter of fixed size is tested in the scan; only what it lets through is shuffled.
    """
    bit = lambda key: F.pmod(key, F.lit(FILTER_BITS))
    place, mask = F.floor(bit(F.col("text_key")) / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit(F.col("text_key")) % 64).cast("int"))
    # At most FILTER_BITS / 64 rows come to the driver, whatever the number of candidates.
    filled = wanted.select(place.alias("place"), mask.alias("mask")).groupBy("place").agg(F.bit_or("mask").alias("bits")).collect()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for row in filled:
        words[row["place"]] = row["bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words.view(np.uint64)
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.int64) % FILTER_BITS
            hit = (table[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(hit.astype(bool)))

    passed = docs.select("text_key", "text").mapInArrow(run, "text_key long, text string")
    return passed.groupBy("text_key").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, docs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are links, by their sets. ``known``: set_id, text_key."""
    pairs = materialize(pairs, "candidate-pairs")
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = materialize(ids.join(known.select("set_id", "text_key"), "set_id"), "candidate-sets")

    def start() -> Step:
        def step(values: pa.Array) -> list[pa.Array]:
            return [pa.array([shingle_set(v.as_py()).tobytes() for v in values], pa.binary())]

        return step

    texts = wanted.join(_picked(docs, wanted), "text_key")
    found = materialize(add_columns(texts, start, "shingles binary", ["text"], ["set_id"]), "candidate-shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for at in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(c)[at].as_py(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep[at] = 100 * common >= LEAST * (len(left) + len(right) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    for side in ("a", "b"):
        pairs = pairs.join(found.select(F.col("set_id").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    return pairs.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long")


def leader_pairs(shared: DataFrame) -> DataFrame:
    """Every set with the leaders of each of its keys: the set that shares most, and the first one.

    What the copies of a text have in common they have from the text: so where it is there itself, it
    is the set whose keys most others have.
    """
    sizes = shared.groupBy("key").agg(F.count("*").alias("rows"))
    weights = shared.join(sizes, "key").groupBy("set_id").agg(F.sum("rows").alias("weight"))
    ends = shared.join(weights, "set_id").groupBy("key")
    ends = ends.agg(F.max_by("set_id", F.struct("weight", "set_id")).alias("most"), F.min("set_id").alias("first"))
    met = shared.join(ends, "key").select("set_id", F.explode(F.array("most", "first")).alias("end")).where("set_id != end")
    return met.select(F.least("set_id", "end").alias("a"), F.greatest("set_id", "end").alias("b")).distinct()


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``n_shingles`` and ``component_id``.

    component_id is the smallest id that links lead to, the document's own included. Documents with
    equal sets are linked. Null and empty texts, and texts without words, have an empty set and are
    linked with nothing. A null id is never the smallest; where no document of a component has an
    id, component_id is null. Repeated rows are rows. Other columns are not read. An empty table
    gives no rows.
    """
    slim = docs.select(column(doc_id).alias("doc_id"), F.xxhash64(column(text)).alias("text_key"), column(text).alias("text"))
    made = materialize(sets(slim), "shingle-sets")
    shared = materialize(shared_keys(made), "shared-keys")
    members = shared.select("set_id").distinct()
    # One row per set that shares a key; a set's size and sketch are those of any of its documents.
    first = F.min_by(F.struct("n", "sketch", "text_key"), "text_key").alias("s")
    known = made.where("n > 0").select("set_id", "n", "sketch", "text_key").join(members, "set_id", "left_semi")
    known = materialize(known.groupBy("set_id").agg(first).select("set_id", "s.*"), "known-sets")
    slim_known = known.select("set_id", "n", "sketch")

    links = materialize(verified(pass_sketch(leader_pairs(shared), slim_known), slim, known), "links")
    roots = connected(links)
    more = materialize(verified(crossing_pairs(shared, slim_known, roots), slim, known), "links")
    roots = connected(links.union(more)).withColumnRenamed("node", "set_id")

    firsts = made.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    rooted = firsts.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("set_id", "component_id")
    linked = made.where("n > 0").select("doc_id", "n", "set_id").join(named, "set_id")
    alone = made.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n", "component_id").union(alone).toDF(doc_id, "n_shingles", "component_id")
