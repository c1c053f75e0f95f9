"""Spelling variants: words one edit apart, found by walking a trie that is a table.

The trie is compressed: its nodes are the prefixes after which the words of the vocabulary differ
or end, its edges carry the code points between two nodes. A node is known by a hash of its prefix,
so the edge table is a plain DataFrame, and a step of the search is a join with it.

A state is (word, what of it is not yet read, node, edits). States without edits are the nodes on
the word's own path. Each is joined with all edges of its node: the first code point of an edge may
replace the word's next one or be inserted before it, or the word's next one is left out. From then
on a state has its one edit and follows the only edge that begins with its next code point, level
by level; a state that has read its word at a node where a word ends has found a neighbour.

Every edit lies in the first or in the second half of a word. Words are walked from the front with
edits in the second half only, and reversed, in a second trie of the same table, with edits in the
first. So no walk begins at the shallow nodes, which all words share; what a state is joined with
are the children of one node, at most one per letter of the alphabet. A node passed by a third
of all words is split by the skew join, as the edges of a node are few.

Hashes that collide could only add paths: every neighbour found is compared with its word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import column, slices, texts
from doclake.sources.workspace import materialize

# Letters of a run, once A-Z are lower-cased.
RUNS = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# One run in so many loses a code point.
TYPO = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
# Different words a task counts before it gives them out.
MOST_WORDS = 1 << 19
# No walk begins above this depth: words have LEAST_LENGTH code points at least.
LEAST_DEPTH = LEAST_LENGTH // 2


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of the texts of a task, given out whenever there are many words.

    The checksum of ``<id>:<run>`` goes on from that of ``<id>:``, once for each run of a text.
    """
    total: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        long = {w: n for w, n in total.items() if len(w) >= LEAST_LENGTH and n}
        total.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(long), pa.string()), pa.array(list(long.values()), pa.int64())], names=["word", "n"])

    for batch in (part for whole in batches for part in slices(whole)):
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            found = RUNS.findall(text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass"))
            total.update(found)
            kinds = list(set(found))
            start = zlib.crc32(f"{doc_id}:".encode())
            hashes = np.fromiter(map(zlib.crc32, map(str.encode, kinds), repeat(start)), np.int64, len(kinds))
            hit = np.flatnonzero(hashes % TYPO == 0)
            if not len(hit):
                continue
            chosen = {kinds[i]: int(hashes[i]) for i in hit}
            for run, n in Counter(r for r in found if r in chosen).items():
                at = chosen[run] % len(run)
                total[run] -= n
                total[run[:at] + run[at + 1 :]] += n
            if len(total) >= MOST_WORDS:
                yield out()
        if len(total) >= MOST_WORDS:
            yield out()
    yield out()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words that are long and frequent enough, A-Z lower-cased, after the typos that
    id and run decide."""
    slim = docs.select(F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"), column(text).alias("text"))
    counted = slim.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every prefix of a word: its hash, length and the code point after it (0 at the end)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            keys, depths, nodes, after = [], [], [], []
            for key, text, seed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                hasher = xxhash.xxh3_64(seed=seed)
                hasher.update(text[:LEAST_DEPTH])
                for depth in range(LEAST_DEPTH, len(text)):
                    letter = text[depth]
                    nodes.append(hasher.intdigest())
                    after.append(ord(letter))
                    hasher.update(letter)
                nodes.append(hasher.intdigest())
                after.append(0)
                depths.extend(range(LEAST_DEPTH, len(text) + 1))
                keys.extend([key] * (len(text) + 1 - LEAST_DEPTH))
            arrays = [pa.array(keys, pa.int64()), pa.array(depths, pa.int32()), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(after, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "depth", "node", "after"])


def _bit(code: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (code % 64).cast("int"))


def paths(words: DataFrame) -> DataFrame:
    """``key, text, seed, path``: the nodes on the path of every word, front to end.

    ``words`` has key, text and seed, which says the trie. A path element is (depth, node, ends, bits,
    owned); one of the words that pass a node owns it.
    """
    prefixes = words.select("key", "text", "seed").mapInArrow(_prefixes, "key long, depth int, node long, after int")
    prefixes = materialize(prefixes, "prefixes")
    low, high = F.min("after"), F.max("after")
    # A bit for each code point that may follow, modulo 64; the end has none.
    following = F.bit_or(F.when(F.col("after") > 0, _bit(F.col("after"))).otherwise(F.lit(0).cast("long")))
    shared = F.min("key").alias("owner")
    nodes = prefixes.groupBy("node").agg((low == 0).alias("ends"), ((low == 0) | (low != high)).alias("kept"), following.alias("bits"), shared)
    found = prefixes.drop("after").join(nodes.where("kept").drop("kept"), "node")
    # A word has at most as many nodes as code points.
    listed = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "ends", "bits", (F.col("owner") == F.col("key")).alias("owned")))).alias("path"))
    return materialize(words.join(listed, "key"), "paths")


def edges(walked: DataFrame) -> DataFrame:
    """``parent, first, label, child, ends, bits``: the edge table of the tries; ends and bits are the
    child's."""
    this, after = lambda i: F.element_at("path", i), lambda i: F.element_at("path", i + 1)
    pair = lambda i: F.struct(
        this(i)["node"].alias("parent"),
        F.substring("text", this(i)["depth"] + 1, after(i)["depth"] - this(i)["depth"]).alias("label"),
        after(i)["node"].alias("child"),
        after(i)["ends"].alias("ends"),
        after(i)["bits"].alias("bits"),
    )
    # The owner of a node gives the edge to it, so every edge comes once.
    owned = F.filter(F.sequence(F.lit(1), F.size("path") - 1), lambda i: after(i)["owned"])
    listed = F.when(F.size("path") > 1, F.transform(owned, pair))
    rows = walked.select(F.explode(listed).alias("e")).select("e.*")
    return materialize(rows.withColumn("first", F.substring("label", 1, 1)), "trie-edges")


def _tail(text: Column, skip: Column) -> Column:
    """``text`` without its first ``skip`` code points."""
    return F.substring(text, skip + 1, F.length(text))


def _goes_on() -> Column:
    """Whether a state has found a word, or its node has an edge that may begin with its next letter."""
    bit = _bit(F.ascii("rest"))
    return F.when(F.col("rest") == "", F.col("ends")).otherwise(F.col("bits").bitwiseAND(bit) != 0)


STATE = ["key", "rest", "node", "ends"]


def _first_edits(walked: DataFrame, table: DataFrame) -> DataFrame:
    """States after their one edit: ``key, rest, node, ends``."""
    own = F.filter("path", lambda p: p["depth"] >= F.col("begin"))
    at = walked.select("key", "text", F.explode(own).alias("p"))
    unread = at.select("key", _tail(F.col("text"), F.col("p.depth")).alias("rest"), "p.node", "p.ends", "p.bits")
    dropped = unread.where("rest != ''").withColumn("rest", _tail(F.col("rest"), F.lit(1)))
    long, label = F.length("label"), _tail(F.col("label"), F.lit(1))
    replaced = (F.col("first") != F.substring("rest", 1, 1)) & (F.length("rest") >= long) & (label == F.substring("rest", F.lit(2), long - 1))
    inserted = (F.length("rest") >= long - 1) & (label == F.substring("rest", F.lit(1), long - 1))
    met = unread.drop("ends", "bits").join(table, F.col("node") == F.col("parent")).where(replaced | inserted)
    both = F.array(F.when(replaced, _tail(F.col("rest"), long)), F.when(inserted, _tail(F.col("rest"), long - 1)))
    moved = met.select("key", F.explode(F.array_compact(both)).alias("rest"), F.col("child").alias("node"), "ends", "bits")
    return dropped.unionByName(moved).where(_goes_on()).select(*STATE)


def _step(states: DataFrame, table: DataFrame) -> DataFrame:
    """States one edge further down; those that have read their word, or fit no edge, are gone."""
    going = states.where("rest != ''").select("key", "rest", "node", F.substring("rest", 1, 1).alias("next"))
    fits = (F.col("node") == F.col("parent")) & (F.col("next") == F.col("first"))
    met = going.join(table, fits).where(F.col("label") == F.substring("rest", F.lit(1), F.length("label")))
    moved = met.select("key", _tail(F.col("rest"), F.length("label")).alias("rest"), F.col("child").alias("node"), "ends", "bits")
    return moved.where(_goes_on()).select(*STATE)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: all pairs of distinct words one edit apart, in both directions.

    ``words`` has distinct, non-null words of LEAST_LENGTH code points at least.
    """
    half = F.floor(F.length("word") / 2).cast("int")
    forward = words.select("word", F.col("word").alias("text"), F.lit(0).alias("seed"), half.alias("begin"))
    backward = words.select("word", F.reverse("word").alias("text"), F.lit(1).alias("seed"), (F.length("word") - half).alias("begin"))
    both = materialize(forward.union(backward).withColumn("key", F.monotonically_increasing_id()), "oriented-words")
    walked = paths(both)
    table = edges(walked)
    states = materialize(_first_edits(walked, table), "frontier")
    found = states.where("rest = ''").select("key", "node")
    while not states.where("rest != ''").isEmpty():
        states = materialize(_step(states, table), "frontier")
        found = found.union(states.where("rest = ''").select("key", "node"))
    ended = walked.select(F.element_at("path", -1)["node"].alias("node"), F.col("word").alias("near"))
    pairs = found.distinct().join(ended, "node").join(both.select("key", "word"), "key")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "near").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form, by doubling: a form is at least twice as frequent as its
    word, so chains have fewer links than a count has bits."""
    current = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = current.join(onward, "root", "left")
        current = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")
        current = current.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the most frequent near word, ties to the first in code-point order, if it occurs
    at least twice as often; root is the last form of the chain. A null or empty text has no words, a
    null id counts as empty text in the typos. Repeated rows count each time. Columns besides the two
    named are not read. An empty table gives no rows.
    """
    words = materialize(vocabulary(docs, doc_id, text), "vocabulary")
    pairs = neighbours(words.select("word"))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = pairs.join(counts, "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    usual = -F.col("best.less") >= 2 * F.col("n")
    judged = materialize(
        joined.select(
            "word",
            F.when(usual, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
