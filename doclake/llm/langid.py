"""Language identification by compression.

Each language has a raw-content dictionary of lower-cased sample text. A text is compressed with every
dictionary, block by block so that the dictionary counts to the end of a long text, and the
language with the smallest total wins.

A text is rejected if the winner's dictionary saves too little of its size without dictionary (it is
in no learned language), or the runner-up is almost as small as the winner. Both are shares of the
size without dictionary, and so do not depend on length or repetition. The bounds come from texts
of the learning documents, sized with dictionaries of the other documents.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, column

# Bounds of the sample the dictionaries are made of: rows per language, characters of each row, and
# bytes of all dictionaries together.
ROWS = 800
CHARS = 300
DICTIONARY_BYTES = 16 << 20
BLOCK = 1 << 11
# Texts of fewer bytes are also compressed with each of the parts of a dictionary: whole bytes alone
# seldom tell languages apart in so little text, their mean over the parts does.
SHORT = 1 << 8
PARTS = 8
LEVEL = 5
# Hashes of rows are dealt to so many places.
PLACES = 1 << 40
# Texts per language by which the bounds are calibrated, and characters of each.
CALIBRATED = 100
CALIBRATED_CHARS = 1 << 12
# A bound is this share of the quantile of the calibrating texts.
QUANTILE, ALLOWED = 0.05, 1 / 3
# Least saving by the winner, and least margin to the runner-up, where nothing calibrates them.
LEAST_SAVED, LEAST_MARGIN = 0.02, 0.025
UNKNOWN = "und"
# Between the pieces of a dictionary.
SEPARATOR = b"\n\n"


class Learned(dict):
    """Dictionaries by language, and ``limits``: the least saving and the least margin."""

    limits = (LEAST_SAVED, LEAST_MARGIN)


def _dictionaries(rows: list[tuple[str, str]]) -> dict[str, bytes]:
    pieces: dict[str, dict[bytes, None]] = {}
    for name, piece in rows:
        pieces.setdefault(name, {})[piece.lower().encode()] = None  # equal pieces count once
    most = DICTIONARY_BYTES // max(1, len(pieces))
    return {name: SEPARATOR.join(found)[-most:] for name, found in pieces.items()}


def _limits(rows: list) -> tuple[float, float]:
    """Bounds by texts whose own pieces are not in the dictionaries that size them."""
    saved, margins = [], []
    for own in (0, 1):
        sizer = Sizer(_dictionaries([(r.lang, r.piece) for r in rows if r.n % 2 != own]))
        for r in rows:
            if r.start is not None and r.n % 2 == own and r.lang in sizer.names and any(map(str.isalpha, r.start)):
                saving, margin = sizer.shares(r.start)[1:]
                saved.append(saving)
                margins.append(margin)
    pairs = ((saved, LEAST_SAVED), (margins, LEAST_MARGIN))
    # A bound of nothing would reject nothing: half of what holds without calibration is the least.
    return tuple(max(ALLOWED * float(np.quantile(v, QUANTILE)), least / 2) if v else least for v, least in pairs)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Learned:
    """A dictionary per language, of the middle of the ROWS documents whose id and text hash lowest.

    Rows with null text or language are not used. The sample is bounded: ROWS x CHARS characters a
    language, and DICTIONARY_BYTES in all; the limits are by CALIBRATED of the rows.
    """
    value = column(text)
    usable = docs.where(value.isNotNull() & (value != "") & column(lang).isNotNull())
    # Rows, not ids, are sampled: an id that repeats is no larger than its texts.
    place = F.pmod(F.xxhash64(column(doc_id), value), F.lit(PLACES))
    # Counts settle from which place on rows can be left out where they are read: about 2 * ROWS of a
    # language pass. Equal rows share a place, so different places are counted.
    counts = usable.groupBy(column(lang).alias("lang")).agg(F.approx_count_distinct(place).alias("rows"))
    bound = F.greatest(F.lit(1.0), F.lit(2.0 * ROWS) * PLACES / F.greatest("rows", F.lit(1)))
    middle = F.substring(value, (F.greatest(F.lit(0), F.length(value) - CHARS) / 2).cast("int") + 1, F.lit(CHARS))
    pool = usable.select(
        column(lang).alias("lang"), middle.alias("piece"), F.substring(value, 1, CALIBRATED_CHARS).alias("start"), place.alias("place")
    )
    # A row per language: as few as the dictionaries, all of which every task holds.
    chosen = pool.join(F.broadcast(counts.select("lang", bound.alias("bound"))), "lang").where("place < bound")
    once = chosen.dropDuplicates(["lang", "place"])
    first = Window.partitionBy("lang").orderBy("place", "piece")
    sample = once.withColumn("n", F.row_number().over(first)).where(F.col("n") <= ROWS)
    rows = sample.withColumn("start", F.when(F.col("n") <= CALIBRATED, F.col("start"))).orderBy("lang", "n").collect()
    learned = Learned(_dictionaries([(r.lang, r.piece) for r in rows]))
    learned.limits = _limits(rows)
    return learned


class Sizer:
    """Compressed sizes of a text by language."""

    def __init__(self, dictionaries: dict[str, bytes], limits: tuple[float, float] | None = None) -> None:
        self.names = sorted(dictionaries)
        self.limits = limits or getattr(dictionaries, "limits", Learned.limits)
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
        self.header = len(self.plain(b""))
        self.whole = [self.compressor(dictionaries[name]) for name in self.names]
        self.parts = []
        for name in self.names:
            pieces = dictionaries[name].split(SEPARATOR)
            self.parts.append([self.compressor(SEPARATOR.join(pieces[at::PARTS])) for at in range(PARTS)])

    @staticmethod
    def compressor(content: bytes) -> Callable[[bytes], bytes]:
        sample = zstandard.ZstdCompressionDict(content or SEPARATOR, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sample.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=sample, write_content_size=False, write_dict_id=False).compress

    def sizes(self, raw: bytes) -> list[float]:
        blocks = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
        sizes = [float(sum(len(compress(block)) for block in blocks)) for compress in self.whole]
        if len(raw) < SHORT:
            means = [sum(len(compress(raw)) for compress in parts) / len(parts) for parts in self.parts]
            sizes = [(size + mean) / 2 for size, mean in zip(sizes, means, strict=True)]
        return sizes

    def shares(self, text: str) -> tuple[list[float], float, float]:
        """Sizes, and what the winner saves and the runner-up loses, as shares of the plain size."""
        raw = text.lower().encode()
        sizes = self.sizes(raw)
        # Without the header of each block, which is half of a very short one.
        plain = sum(len(self.plain(raw[at : at + BLOCK])) - self.header for at in range(0, len(raw), BLOCK))
        least, *others = sorted(sizes)
        return sizes, (plain + self.header * -(-len(raw) // BLOCK) - least) / plain, (others[0] - least) / plain if others else 1.0

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score, and whether the text is rejected."""
        if not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes, saved, margin = self.shares(text)
        least = min(sizes)
        # Each byte more halves a language's weight.
        score = 1.0 / sum(2.0 ** (least - size) for size in sizes)
        return self.names[sizes.index(least)], score, saved < self.limits[0] or margin < self.limits[1]

    def step(self, column: pa.Array) -> list[pa.Array]:
        found = [self.predict(value.as_py() or "") for value in column]
        kinds = (pa.string(), pa.float64(), pa.bool_())
        return [pa.array([row[at] for row in found], kind) for at, kind in enumerate(kinds)]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_narrow``, whether the text is rejected:
    the winner saves too little, or its margin is too narrow.

    A text that is null, empty or without letter, and any text if no language was learned, is
    ``und`` with score 0, and counts as narrow. Equal sizes go to the name that comes first. Input
    columns (or ``keep`` of them) are kept, and replaced where they have a new column's name;
    repeated rows are judged each; an empty table gives no rows.
    """
    limits = getattr(dictionaries, "limits", Learned.limits)
    shared = docs.sparkSession.sparkContext.broadcast((dict(dictionaries), limits))

    def start() -> Step:
        return Sizer(*shared.value).step

    return add_columns(docs, start, "lang_pred string, lang_score double, lang_narrow boolean", [text], keep)
