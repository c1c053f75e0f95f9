"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled text train a linear model that minimises the non-negative
unbiased risk: the risk of the positives weighed by the class prior, plus the part of the unlabelled
text's negative risk that the positives do not explain, which is not let below zero. The prior
itself is estimated from both samples. Features are of the whole text: frequencies of pairs of
character classes, and how much words and lines repeat, and how far these lie outside what the
trusted positives show.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, column, free_name

# Bounds of the two samples the model is fitted to.
POSITIVES = 8000
UNLABELLED = 8000
# Rows and columns of a sample that are worked on at a time, where that makes copies.
ROWS, COLUMNS = 500, 64
# Hashes of rows are dealt to so many places.
PLACES = 1 << 40

ROUNDS = 400
RATE = 0.05
PENALTY = 1e-3
# Scaled features are cut off here, in training and in scoring.
CLIP = 10.0
# The model that tells the two samples apart is kept simpler: it is read on the other half.
SPLIT_ROUNDS = 100
SPLIT_PENALTY = 1e-2

# Classes of bytes: each ASCII punctuation mark is one of its own.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _BEYOND, _CONTROL = range(7)
CLASSES = 7 + len(_MARKS)


def byte_classes() -> np.ndarray:
    out = np.full(256, _CONTROL, np.int64)
    out[ord("a") : ord("z") + 1], out[ord("A") : ord("Z") + 1], out[ord("0") : ord("9") + 1] = _LOWER, _UPPER, _DIGIT
    out[[9, 32]], out[[10, 13]], out[128:] = _BLANK, _LINE, _BEYOND
    for at, mark in enumerate(_MARKS):
        out[ord(mark)] = 7 + at
    return out


# Beside the pairs: repeats of the word before, of any earlier word, of any earlier line, the mean
# length of words, and the logarithm of the length.
EXTRA = 5
RAW = CLASSES * CLASSES + EXTRA
# The model's features: the raw ones, kept inside the range of the trusted positives; how far each of
# the last ones lies outside it; and how far all pairs together do.
FEATURES = RAW + EXTRA + 1


class Reader:
    def __init__(self) -> None:
        self.classes = byte_classes()

    def features(self, raw: bytes) -> np.ndarray:
        out = np.zeros(RAW, np.float32)
        kind = self.classes[np.frombuffer(raw, np.uint8)]
        if len(kind) > 1:
            pairs = np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=CLASSES * CLASSES)
            out[:-EXTRA] = np.sqrt(pairs / (len(kind) - 1))
        words, lines = raw.split(), raw.split(b"\n")
        n = max(1, len(words))
        out[-EXTRA:] = (
            sum(map(eq, words, words[1:])) / n,
            1 - len(set(words)) / n,
            1 - len(set(lines)) / len(lines),
            sum(map(len, words)) / n / 10,
            np.log1p(len(raw)) / 10,
        )
        return out

    def matrix(self, column: pa.Array) -> np.ndarray:
        return np.stack([self.features((value.as_py() or "").encode()) for value in column]) if len(column) else np.zeros((0, RAW), np.float32)


@dataclass
class Sample:
    """Rows of raw features, each packed: most features of a row are zero. A slice is a matrix."""

    rows: list[bytes]

    @staticmethod
    def packed(matrix: np.ndarray) -> list[bytes]:
        return [zlib.compress(row.tobytes(), 1) for row in matrix]

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.rows), RAW

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: slice) -> np.ndarray:
        rows = self.rows[at]
        out = np.empty((len(rows), RAW), np.float32)
        for i, row in enumerate(rows):
            out[i] = np.frombuffer(zlib.decompress(row), np.float32)
        return out


@dataclass
class Span:
    """The range of every raw feature over the trusted positives.

    A linear model has no sense of too much: what lies beyond all trusted text earns no more than the
    edge of it, and counts by its distance instead.
    """

    low: np.ndarray
    high: np.ndarray
    spread: np.ndarray

    @classmethod
    def of(cls, positive: np.ndarray) -> Span:
        spread = [positive[:, at : at + COLUMNS].std(axis=0) for at in range(0, positive.shape[1], COLUMNS)]
        return cls(positive.min(axis=0), positive.max(axis=0), np.concatenate(spread) + np.float32(1e-3))

    def features(self, matrix: np.ndarray | Sample) -> np.ndarray:
        out = np.empty((len(matrix), FEATURES), np.float32)
        # By blocks of rows: the driver holds a sample once, and packed.
        for at in range(0, len(matrix), ROWS):
            rows = matrix[at : at + ROWS]
            inside = np.clip(rows, self.low, self.high)
            beyond = rows - inside
            out[at : at + ROWS, :RAW] = inside
            out[at : at + ROWS, RAW:-1] = np.clip(np.abs(beyond[:, -EXTRA:]) / self.spread[-EXTRA:], 0, CLIP)
            out[at : at + ROWS, -1] = np.sqrt(np.square(beyond[:, :-EXTRA]).sum(axis=1))
        return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    span: Span

    def log_odds(self, matrix: np.ndarray) -> np.ndarray:
        scaled = np.clip((self.span.features(matrix) - self.mean) / self.scale, -CLIP, CLIP)
        return scaled @ self.weights + self.bias

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(matrix), -500, 500)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _back(slope: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Slopes of the rows' scores to slopes of the weights; the rows stay in single precision."""
    return (slope.astype(np.float32) @ rows).astype(np.float64)


def _descend(gradient, size: int, start: float, rounds: int) -> tuple[np.ndarray, float]:
    """Adam over a weight vector and a bias."""
    values, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    values[-1] = start
    for n in range(1, rounds + 1):
        g = gradient(values)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        values = values - RATE * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-8)
    return values[:-1], float(values[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled sample, from scores that tell the two samples apart.

    Above any threshold the unlabelled sample holds at least the prior times the positives' share, so
    the smallest ratio is an estimate. Thresholds that leave less than half of the positives don't count.
    """
    best = 1.0
    for limit in np.quantile(positive, np.linspace(0.0, 0.5, 51)):
        share = (positive >= limit).mean()
        best = min(best, float((unlabelled >= limit).mean() / share))
    return min(max(best, 0.01), 0.99)


def separation(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of both samples, each half by a model of the other half."""
    scores = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for half in (0, 1):
        p, u = positive[half::2], unlabelled[half::2]

        def slope(values: np.ndarray, p: np.ndarray = p, u: np.ndarray = u) -> np.ndarray:
            w, b = values[:-1], values[-1]
            short = w.astype(np.float32)
            gp, gu = -_sigmoid(-(p @ short + b)) / max(1, len(p)), _sigmoid(u @ short + b) / max(1, len(u))
            return np.r_[_back(gp, p) + _back(gu, u) + SPLIT_PENALTY * w, gp.sum() + gu.sum()]

        w, b = _descend(slope, FEATURES, 0.0, SPLIT_ROUNDS)
        for values, sample in zip(scores, (positive, unlabelled), strict=True):
            other = sample[1 - half :: 2]
            # By blocks of rows: the product makes a copy in double precision.
            parts = [other[at : at + ROWS] @ w + b for at in range(0, len(other), ROWS)]
            values[1 - half :: 2] = np.concatenate(parts) if parts else 0.0
    return scores


def fit(positive: np.ndarray | Sample, unlabelled: np.ndarray | Sample) -> Model:
    """Fits the model to the features of both samples; without positives every score is 0.5."""
    if not len(positive) or not len(unlabelled):
        span = Span(np.zeros(RAW, np.float32), np.zeros(RAW, np.float32), np.ones(RAW, np.float32))
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 0.5, span)
    span = Span.of(positive[:])
    positive = span.features(positive)
    unlabelled = span.features(unlabelled)
    n = len(positive) + len(unlabelled)
    mean = (positive.sum(axis=0, dtype=np.float64) + unlabelled.sum(axis=0, dtype=np.float64)) / n
    centre = mean.astype(np.float32)
    parts = (each[at : at + ROWS] for each in (positive, unlabelled) for at in range(0, len(each), ROWS))
    square = sum(np.square(part - centre).sum(axis=0, dtype=np.float64) for part in parts)
    scale = np.sqrt(square / n)
    scale = np.where(scale > 1e-6, scale, 1.0)
    small = mean.astype(np.float32), scale.astype(np.float32)
    for each in (positive, unlabelled):
        each -= small[0]
        each /= small[1]
        np.clip(each, -CLIP, CLIP, out=each)
    p, u = positive, unlabelled
    prior = estimate_prior(*separation(p, u))

    def risk(values: np.ndarray) -> np.ndarray:
        """Gradient of the non-negative risk under the logistic loss."""
        w, b = values[:-1], values[-1]
        sp, su = (each @ w.astype(np.float32) + b for each in (p, u))
        unexplained = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        gp = -prior * _sigmoid(-sp) / len(p)
        negative_p, negative_u = -prior * _sigmoid(sp) / len(p), _sigmoid(su) / len(u)
        if unexplained < 0:  # overfitted: climb back instead
            negative_p, negative_u, gp = -negative_p, -negative_u, np.zeros_like(gp)
        gp = gp + negative_p
        return np.r_[_back(gp, p) + _back(negative_u, u) + PENALTY * w, gp.sum() + negative_u.sum()]

    weights, bias = _descend(risk, FEATURES, float(np.log(prior / (1 - prior))), ROUNDS)
    return Model(mean, scale, weights, bias, prior, span)


def learn(docs: DataFrame, positives: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Fits a model to the documents named in ``positives`` (doc_id) and to ``docs`` as unlabelled text.

    Both samples are bounded (POSITIVES, UNLABELLED) and chosen by hashes of id and text, so they
    are the same in any run. Equal rows count once; null ids are not sampled.
    """
    key = free_name(docs, "_sampled")

    def sample(ids: DataFrame, most: int, seed: int) -> Sample:
        found = ids.select(column(doc_id).alias(key)).where(F.col(key).isNotNull()).distinct()
        # At most ``most`` ids; an id can have any number of rows.
        chosen = found.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(most)
        rows = docs.join(F.broadcast(chosen), column(doc_id) == F.col(key), "left_semi")
        place = F.pmod(F.xxhash64(column(doc_id), column(text), F.lit(seed)), F.lit(PLACES))
        rows = rows.select(place.alias("place"), column(text).alias("text"))
        # About twice as many as needed pass the scan, whatever the number of rows.
        different = rows.agg(F.approx_count_distinct("place")).head()[0]
        few = rows.where(F.col("place") < max(1, 2 * most * PLACES // max(1, different)))

        def start() -> Step:
            reader = Reader()
            return lambda values: [pa.array(Sample.packed(reader.matrix(values)), pa.binary())]

        packed = add_columns(few, start, "features binary", ["text"], ["place"]).dropDuplicates(["place"])
        return Sample([value.as_py() for value in packed.orderBy("place").limit(most).toArrow()["features"]])

    return fit(sample(positives, POSITIVES, 1), sample(docs, UNLABELLED, 2))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``quality_score`` (0 to 1, higher is better) of the whole text.

    A null text is scored as the empty one. Input columns (or ``keep`` of them) are kept, and
    replaced where they have the new column's name; repeated rows are scored each; an empty table
    gives no rows.
    """

    def start() -> Step:
        reader = Reader()
        return lambda values: [pa.array(model.scores(reader.matrix(values)).astype(np.float64), pa.float64())]

    return add_columns(docs, start, "quality_score double", [text], keep)
