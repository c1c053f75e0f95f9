"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are counted over all training documents. The most frequent words are classes of their own,
the others fall into classes by their last bytes, so any word, seen or not, has a class, and a text
is a sequence of classes. The probability of a word is that of its class after the two classes
before, times its share of the class.

The class model is log-bilinear: the two context vectors, each through its own matrix, predict a
vector, and a class scores by its inner product with it. What training needs of the corpus is the
counts of class triples, aggregated over all training documents; every round, tasks turn their part
of the contexts into a gradient in numpy, with the expectation over the noise distribution in
place of samples of it, and the driver takes a step. Scoring normalises exactly: batched matrix
products give the sum over all classes for every context of two classes.

Counts of the FREQUENT words go to the tasks, a bounded table; the counts of all others are
joined, summed up per document before.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, slices
from doclake.sources.workspace import materialize

# Words whose counts are broadcast; the most frequent of them that are classes; classes by suffix.
FREQUENT = 1 << 18
WORDS = 125
SUFFIXES = 128
SUFFIX_BYTES = 3
# Steps of the logarithm of a count in which the least count of the frequent words is found.
STEPS = 64
BEGIN, END, FIRST = 0, 1, 2

WIDTH = 16
NOISE = 8
ROUNDS = 40
RATE = 0.05
SEED = 7
# Partitions of the context table: contexts are bounded by the square of the classes.
PARTS = 12
# Different words or triples a counting task holds before it passes them on.
HELD = 1 << 18


@dataclass
class Vocabulary:
    """Bounded statistics of the training documents."""

    tokens: int
    types: int
    ends: int
    words: list[bytes]
    counts: np.ndarray
    suffixes: list[bytes]
    class_tokens: np.ndarray
    class_types: np.ndarray

    @property
    def classes(self) -> int:
        return FIRST + len(self.own) + len(self.suffixes) + 1

    @property
    def own(self) -> list[bytes]:
        return self.words[:WORDS]

    def suffix_classes(self) -> dict[bytes, int]:
        return {suffix: FIRST + len(self.own) + at for at, suffix in enumerate(self.suffixes)}


class Classes(dict):
    """Class of a word; words beyond the table go by their suffix."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.other = vocabulary.classes - 1
        self.suffix = vocabulary.suffix_classes()
        first = {word: FIRST + at for at, word in enumerate(vocabulary.own)}
        super().__init__((w, first.get(w, self.suffix.get(w[-SUFFIX_BYTES:], self.other))) for w in vocabulary.words)

    def __missing__(self, word: bytes) -> int:
        return self.suffix.get(word[-SUFFIX_BYTES:], self.other)


def tokens(value: pa.Scalar) -> list[bytes]:
    """The words of a text: A-Z lower-cased, cut at ASCII white space."""
    return (value.as_py() or "").encode().lower().split()


# ---- counts over all training documents


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all rows of ``text``; each task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in (part for whole in batches for part in slices(whole)):
            for value in batch.column(0):
                held.update(tokens(value))
            if len(held) >= HELD:
                yield out()
                held.clear()
        yield out()

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """At most FREQUENT words with their counts, highest first.

    The least count is settled first, from the number of words in each step of a logarithmic scale,
    so no task sorts or gathers more than the words that are kept.
    """
    step = F.floor(F.log(F.col("n")) * STEPS)
    sizes = {r.step: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    kept, total = [], 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > FREQUENT:
            break
        kept.append(at)
    rows = counts.where(step >= (min(kept) if kept else 1 << 30)).toArrow()
    pairs = sorted(zip(rows["n"].to_pylist(), rows["word"].to_pylist(), strict=True), key=lambda p: (-p[0], p[1]))
    return [word.encode() for _, word in pairs], np.array([n for n, _ in pairs], np.int64)


def read_vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    sums = counts.agg(F.sum("n"), F.count("*")).head()
    words, frequent = frequent_words(counts)
    suffix = F.substring(F.col("word").cast("binary"), -SUFFIX_BYTES, SUFFIX_BYTES)
    # Shorter words are their own suffix.
    suffix = F.when(F.octet_length("word") < SUFFIX_BYTES, F.col("word").cast("binary")).otherwise(suffix)
    rest = counts.where(~F.col("word").isin([w.decode() for w in words[:WORDS]])) if words else counts
    by_suffix = rest.groupBy(suffix.alias("suffix")).agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    by_suffix = materialize(by_suffix, "suffixes")
    largest = by_suffix.orderBy(F.col("n").desc(), "suffix").limit(SUFFIXES).collect()
    every = by_suffix.agg(F.sum("n"), F.sum("types")).head()
    class_tokens = np.array([r.n for r in largest], np.int64)
    class_types = np.array([r.types for r in largest], np.int64)
    return Vocabulary(
        tokens=(sums[0] or 0) + documents,
        types=sums[1] + (documents > 0),
        ends=documents,
        words=words,
        counts=frequent,
        suffixes=[bytes(r.suffix) for r in largest],
        class_tokens=np.r_[class_tokens, (every[0] or 0) - class_tokens.sum()],
        class_types=np.r_[class_types, (every[1] or 0) - class_types.sum()],
    )


def _sequence(words: list[list[bytes]], classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all texts one after the other, each with its end; the two before; text starts."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    target = np.full(int(lengths.sum()), END, np.int64)
    is_word = np.ones(len(target), bool)
    is_word[starts + lengths - 1] = False
    target[is_word] = np.fromiter(map(classes.__getitem__, chain.from_iterable(words)), np.int64, int(is_word.sum()))
    one, two = np.r_[BEGIN, target[:-1]], np.r_[BEGIN, BEGIN, target[:-2]][: len(target)]
    one[starts] = two[starts] = BEGIN
    second = starts[lengths > 1] + 1
    two[second] = BEGIN
    return target, one, two, starts


def triple_counts(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``context, class, n``: how often a class follows two others, over all rows of ``text``."""
    size = vocabulary.classes
    shared = texts.sparkSession.sparkContext.broadcast(vars(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(Vocabulary(**shared.value))
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for batch in (part for whole in batches for part in slices(whole)):
            target, one, two, _ = _sequence([tokens(v) for v in batch.column(0)], classes)
            new, n = np.unique((two * size + one) * size + target, return_counts=True)
            merged, where = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n]), len(merged)).astype(np.int64)
            codes = merged
            if len(codes) >= 4 * HELD:
                yield out()
                codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield out()

    summed = texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return summed.select((F.col("code") / size).cast("long").alias("context"), (F.col("code") % size).alias("class"), "n")


# ---- the model


@dataclass
class Model:
    """Context vectors, class vectors, a matrix per context place, a bias per class."""

    context: np.ndarray
    target: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def pack(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def unpack(self, flat: np.ndarray) -> Model:
        sizes = np.cumsum([p.size for p in self.parts()])[:-1]
        return Model(*[f.reshape(p.shape) for f, p in zip(np.split(flat, sizes), self.parts(), strict=True)])

    def predict(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.context[one] @ self.near + self.context[two] @ self.far

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score parts of the nearer and the farther context class, and the log of the sum of all."""
        near = self.context @ self.near @ self.target.T + self.bias
        far = self.context @ self.far @ self.target.T
        size = len(self.bias)
        total = np.empty((size, size))
        for two in range(size):  # a batch of contexts that share the farther class
            scores = near + far[two]
            scores[:, BEGIN] = -np.inf
            top = scores.max(axis=1)
            total[two] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return near, far, total


def _gradient(model: Model, noise: np.ndarray, one: np.ndarray, two: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of the noise-contrastive log likelihood, for contexts with their class counts, a row each."""
    predicted = model.predict(one, two)
    odds = predicted @ model.target.T + model.bias - np.log(NOISE * noise)
    real = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
    slope = counts * (1 - real) - counts.sum(axis=1, keepdims=True) * (NOISE * noise) * real
    slope[:, BEGIN] = 0
    back = slope @ model.target
    context = np.zeros_like(model.context)
    np.add.at(context, one, back @ model.near.T)
    np.add.at(context, two, back @ model.far.T)
    return np.concatenate(
        [
            context.ravel(),
            (slope.T @ predicted).ravel(),
            (model.context[one].T @ back).ravel(),
            (model.context[two].T @ back).ravel(),
            slope.sum(axis=0),
        ]
    )


def unigram(vocabulary: Vocabulary) -> np.ndarray:
    """Noise distribution: share of each class in the training tokens, smoothed."""
    counts = np.ones(vocabulary.classes)
    counts[END] += vocabulary.ends
    own = len(vocabulary.own)
    counts[FIRST : FIRST + own] += vocabulary.counts[:own]
    counts[FIRST + own :] += vocabulary.class_tokens
    counts[BEGIN] = 1e-6
    return counts / counts.sum()


def train(triples: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Rounds over all counts; starts at the shares of the classes, without context."""
    size, noise = vocabulary.classes, unigram(vocabulary)
    generator = np.random.default_rng(SEED)
    model = Model(
        generator.normal(0, 0.3, (size, WIDTH)),
        generator.normal(0, 0.3, (size, WIDTH)),
        np.eye(WIDTH) * 0.5,
        np.eye(WIDTH) * 0.25,
        np.log(noise),
    )
    # A context has at most as many entries as there are classes.
    rows = triples.groupBy("context").agg(F.collect_list(F.struct("class", "n")).alias("seen"))
    rows = materialize(rows.select("context", "seen.class", "seen.n").repartition(PARTS, "context"), "contexts")
    total = max(1, vocabulary.tokens)
    values, first, second = model.pack(), 0.0, 0.0
    for n in range(1, rounds + 1):
        current = model.unpack(values)

        def run(batches: Iterator[pa.RecordBatch], current: Model = current) -> Iterator[pa.RecordBatch]:
            made = np.zeros(len(current.pack()))
            for batch in batches:
                context = batch.column(0).to_numpy()
                lengths = batch.column(1).value_lengths().to_numpy()
                counts = np.zeros((len(context), size))
                at = np.repeat(np.arange(len(context)), lengths)
                counts[at, batch.column(1).flatten().to_numpy()] = batch.column(2).flatten().to_numpy()
                made += _gradient(current, noise, context % size, context // size, counts)
            yield pa.RecordBatch.from_arrays([pa.array([made.tobytes()], pa.binary())], names=["made"])

        parts = rows.mapInArrow(run, "made binary").collect()
        step = -sum((np.frombuffer(p.made, np.float64) for p in parts), np.zeros(len(values))) / total
        first, second = 0.9 * first + 0.1 * step, 0.999 * second + 0.001 * step * step
        values = values - RATE * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-9)
    return model.unpack(values)


# ---- scores


class Scorer:
    def __init__(self, vocabulary: Vocabulary, model: Model) -> None:
        self.classes = Classes(vocabulary)
        self.near, self.far, self.total = model.tables()
        self.unit = np.log10(vocabulary.tokens + vocabulary.types + 1)
        self.end = np.log10(vocabulary.ends + 1) - self.unit
        self.known_end = int(vocabulary.ends > 0)
        self.index = {word: at for at, word in enumerate(vocabulary.words)}
        self.logs = np.log10(vocabulary.counts + 1.0)
        # What a word's class takes off: nothing for a class of one word.
        self.shared = np.zeros(vocabulary.classes)
        self.shared[FIRST + len(vocabulary.own) :] = np.log10(vocabulary.class_tokens + vocabulary.class_types + 1.0)
        self.own = len(vocabulary.own)

    def step(self, column: pa.Array) -> list[pa.Array]:
        """Counts and sums of the frequent words, and the others with their counts, per text."""
        words = [tokens(v) for v in column]
        target, one, two, starts = _sequence(words, self.classes)
        if not len(starts):
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            return [pa.array([], k) for k in kinds]
        model = (self.near[one, target] + self.far[two, target] - self.total[two, one]) / np.log(10)
        sizes = np.array([len(w) for w in words])
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in chain.from_iterable(words)), np.int64, int(sizes.sum()))
        log = np.where(at >= 0, self.logs[at] if len(self.logs) else 0.0, 0.0)
        inside = np.zeros(len(target))
        is_word = target != END
        inside[is_word] = np.where((at >= 0) & (at < self.own), 0.0, log) - self.shared[target[is_word]]
        base = np.full(len(target), self.end)
        base[is_word] = log - self.unit
        known = np.full(len(target), self.known_end)
        known[is_word] = at >= 0
        per_text = lambda values: np.add.reduceat(values, starts)
        rare, places, flat = [], np.flatnonzero(at < 0), [*chain.from_iterable(words)]
        text_of = np.repeat(np.arange(len(words)), sizes)[places]
        cuts = np.searchsorted(text_of, np.arange(len(words) + 1))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            rare.append(Counter(flat[i] for i in places[a:b].tolist()))
        return [
            pa.array(sizes + 1),
            pa.array(per_text(known)),
            pa.array(per_text(base)),
            pa.array(per_text(model + inside)),
            pa.array([[w.decode() for w in r] for r in rare], pa.list_(pa.string())),
            pa.array([list(r.values()) for r in rare], pa.list_(pa.int64())),
        ]


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the documents that are not held out (a null there counts as held out) and
    scores all, whole texts. A null text is the empty one, of which the end is the only token.
    Repeated rows are scored each, and learned from each. Other columns are not read. Without
    training documents the scores are those of the untrained classes. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out")
    )
    training = rows.where(~F.col("held_out"))
    counts = materialize(word_counts(training), "word-counts")
    vocabulary = read_vocabulary(counts, training.count())
    model = train(triple_counts(training, vocabulary), vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vars(vocabulary), vars(model)))

    def start() -> Step:
        counted, trained = shared.value
        return Scorer(Vocabulary(**counted), Model(**trained)).step

    # The number names a row; it is written with it once and then read.
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    fields = "n_tokens long, _known long, _base double, _score double, _rare array<string>, _times array<long>"
    partial = materialize(add_columns(numbered, start, fields, ["text"], ["doc_id", "held_out", "_row"]), "scores")
    pairs = partial.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("pair"))
    pairs = pairs.select("_row", F.col("pair._rare").alias("word"), F.col("pair._times").alias("times"))
    # A word not seen in training adds the logarithm of 1, so the inner join has all there is.
    rare = (
        pairs.join(counts, "word")
        .groupBy("_row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_log"), F.sum("times").alias("_more"))
    )
    log = F.coalesce("_log", F.lit(0.0))
    return partial.drop("_rare", "_times").join(rare, "_row", "left").select(
        F.col("doc_id").alias(doc_id),
        "held_out",
        "n_tokens",
        (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + log).alias("base_score"),
        (F.col("_score") + log).alias("score"),
    )
