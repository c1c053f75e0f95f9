"""Token counts of whole texts by a public tokenizer, with bounded work per call of the library.

A huge document is encoded in overlapping chunks with offsets. Where two chunks overlap they are
spliced at a stable common boundary: a place where both have a token begin, and of which it is
proven that no token, and nothing the tokenizer does before merging, reaches across it. If the
overlap has none, it is widened; if it grows to the chunk itself, the chunk grows.

For tokenizers that drop white space, a place after ASCII white space is such a boundary in any
text. So ordinary documents are counted word by word, each different word once per cache.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import Step, add_columns, column

CHUNK = 1 << 15
OVERLAP = 1 << 9
# Different words whose counts a task remembers.
CACHED = 1 << 18

ASCII_SPACE = " \t\n\v\f\r"


class Counter:
    """Counts tokens with one tokenizer; ``starts`` gives where the tokens of a string begin."""

    def __init__(self, specification: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        # The library would start a thread per core in every task.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(specification)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.words: dict[bytes, int] = {}
        self.widened = 0

    def starts(self, text: str) -> np.ndarray:
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array([a for a, _ in encoding.offsets], np.int64)

    def long(self, text: str, starts: Callable[[str], np.ndarray] | None = None) -> int:
        """Tokens of a text of any length, from chunks."""
        starts = starts or self.starts
        total, low, end = 0, 0, min(len(text), self.chunk)
        current = starts(text[:end])
        while end < len(text):
            overlap = self.overlap
            while True:
                begin = end - overlap
                if begin <= low:  # no boundary in the whole chunk: it has to grow
                    end = min(len(text), low + 2 * (end - low))
                    current = current[:0] if low == 0 else current
                    following, cut = starts(text[low:end]) + low, low
                    break
                end_of_next = min(len(text), begin + self.chunk)
                if end_of_next <= end:
                    end_of_next = min(len(text), end + self.chunk)
                following = starts(text[begin:end_of_next]) + begin
                cut = self.common(text, current, following, begin, end)
                if cut:
                    end = end_of_next
                    break
                overlap *= 2
                self.widened += 1
            total += int(((current >= low) & (current < cut)).sum())
            current, low = following, cut
        return total + int((current >= low).sum())

    @staticmethod
    def common(text: str, left: np.ndarray, right: np.ndarray, begin: int, end: int) -> int:
        """The last boundary that both have inside the overlap and that is proven stable, or 0."""
        both = np.intersect1d(left, right)
        for place in both[(both > begin) & (both < end)][::-1].tolist():
            if text[place - 1] in ASCII_SPACE:
                return place
        return 0

    def step(self, column: pa.Array) -> list[pa.Array]:
        counts: list[int] = []
        short: list[list[bytes] | None] = []
        for value in column:
            text = value.as_py() or ""
            short.append(text.encode().split() if len(text) <= self.chunk else None)
            counts.append(0 if short[-1] is not None else self.long(text))
        if len(self.words) > CACHED:
            self.words.clear()
        new = list({word for words in short if words for word in words}.difference(self.words))
        found = self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        self.words.update(zip(new, map(len, found), strict=True))
        count = self.words.__getitem__
        return [pa.array([n if words is None else sum(map(count, words)) for n, words in zip(counts, short, strict=True)], pa.int64())]


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, keep: list[str] | None = None
) -> DataFrame:
    """Adds ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    ``path`` is a tokenizer file that drops white space; the driver reads it and broadcasts its
    text, a fixed size. No special tokens are added; strings of special tokens in a text count as
    the library counts them. A null or empty text has 0 bytes and 0 tokens. Columns with the new
    names are replaced, all others (or ``keep`` of them) kept; repeated rows are counted each; an
    empty table gives no rows.
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def start() -> Step:
        return Counter(shared.value, chunk, overlap).step

    size = F.coalesce(F.octet_length(column(text)), F.lit(0)).cast("long")
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_bytes", "n_tokens")]
    sized = docs.select(*[column(c) for c in dict.fromkeys([*names, text])], size.alias("n_bytes"))
    return add_columns(sized, start, "n_tokens long", [text], [*names, "n_bytes"])
