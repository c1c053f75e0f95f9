"""Byte-level BPE encoding and decoding, by the vocabulary of a rank file.

Pre-tokenisation uses no regular expression. The texts of a slice are one array of code points,
turned into symbols (letter, number, white space before white space, ...). Where a token begins is
decided by a small automaton. Each symbol is a function from states to states; functions compose
associatively, so the states at all positions come from a prefix scan over rows of columns, in
numpy. The resulting slices are looked up in a cache, new ones are merged in one go: pieces of one
length are a matrix, and a round merges the lowest pair of every row.

Tokens keep their byte offsets in the text. Decoding copies the bytes of all tokens to their
offsets at once.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from doclake.llm.common import Step, add_columns

# The kinds of symbols. An apostrophe is SHORT or LONG if a contraction of one or two letters
# follows; white space is GAP before more white space or the end, GLUE if it is a blank before
# anything else, ALONE if it is another.
LETTER, NUMBER, OTHER, SHORT, LONG, GAP, GLUE, ALONE, END = range(9)
# What the automaton has read: nothing yet, a run of one kind, a blank to be joined to what
# follows, a contraction of which one or two letters are still to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, AFTER_GLUE, ONE_LEFT, TWO_LEFT = range(8)
# The letters of the contractions.
SHORT_ENDS = "stmd"
LONG_ENDS = ("re", "ve", "ll")
# Code points with the property White_Space.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

WIDTH = 256
GROUP_CHARS = 1 << 20
WINDOW = 1 << 21
CACHED = 1 << 18
LONGEST_CACHED = 64
LONGEST_ROW = 40
NO_PAIR = np.iinfo(np.int32).max

Table = tuple[np.ndarray, np.ndarray]


def _transitions() -> Table:
    """Next state, and whether a token begins, for each symbol and state."""
    following = np.zeros((9, 8), np.uint8)
    begins = np.ones((9, 8), bool)
    for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        following[symbol] = run
        begins[symbol, [run, AFTER_GLUE]] = False
    for symbol, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        following[symbol] = state
        following[symbol, [IN_OTHERS, AFTER_GLUE]] = IN_OTHERS
        begins[symbol, [IN_OTHERS, AFTER_GLUE]] = False
    following[LETTER, [ONE_LEFT, TWO_LEFT]] = FRESH, ONE_LEFT
    begins[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    following[GAP], begins[GAP, IN_GAP] = IN_GAP, False
    following[GLUE], following[ALONE], following[END] = AFTER_GLUE, FRESH, FRESH
    begins[END] = False
    return following, begins


def _monoid(following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions the symbols generate: number of each symbol's, composition, and application."""
    found: dict[tuple[int, ...], int] = {tuple(range(8)): 0}
    waiting = [*found]
    for function in waiting:
        for symbol in following.tolist():
            made = tuple(symbol[state] for state in function)
            if made not in found:
                found[made] = len(found)
                waiting.append(made)
    apply = np.array(list(found), np.uint8)
    compose = np.array([[found[tuple(second[first].tolist())] for second in apply] for first in apply], np.uint16)
    return np.array([found[tuple(row)] for row in following.tolist()], np.uint16), compose, apply


# Letters and numbers that Unicode 16 added, which the tokenizer's library knows and
# the standard module may not.
ADDED_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
ADDED_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


def classes() -> np.ndarray:
    """LETTER, NUMBER, GAP (white space) or OTHER for each code point, as in Unicode 16."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for kind, ranges in ((LETTER, ADDED_LETTERS), (NUMBER, ADDED_NUMBERS)):
        for first, last in ranges:
            out[first : last + 1] = kind
    out[list(WHITE_SPACE)] = GAP
    return out


class Splitter:
    """Finds where tokens begin in texts joined into one string."""

    def __init__(self, classes: np.ndarray) -> None:
        self.classes = classes
        self.following, self.begins = _transitions()
        self.number, compose, self.apply = _monoid(self.following)
        self.compose, self.size = compose.ravel(), len(compose)

    def symbols(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        kind = self.classes[points]
        kind[ends] = GAP
        symbol = kind.copy()
        after = np.r_[points[1:], 0, 0]
        space = kind == GAP
        before_text = space & np.r_[~space[1:], False]
        symbol[before_text] = np.where(points[before_text] == 32, GLUE, ALONE)
        marks = np.flatnonzero(points == ord("'"))
        first, second = after[marks], after[marks + 1]
        symbol[marks[np.isin(first, [ord(c) for c in SHORT_ENDS])]] = SHORT
        for a, b in LONG_ENDS:
            symbol[marks[(first == ord(a)) & (second == ord(b))]] = LONG
        symbol[ends] = END
        return symbol

    def states(self, symbol: np.ndarray, state: int = FRESH) -> tuple[np.ndarray, int]:
        """The state before each position and after the last, given the one before the first.

        A scan over compositions of the symbols' functions."""
        rows = -(-len(symbol) // WIDTH)
        padded = np.zeros(rows * WIDTH, np.uint16)
        padded[: len(symbol)] = self.number[symbol]
        across = np.ascontiguousarray(padded.reshape(rows, WIDTH).T)
        # Within each row: the function of everything up to and including a position.
        scanned = np.empty_like(across)
        scanned[0] = across[0]
        for at in range(1, WIDTH):
            scanned[at] = self.compose[scanned[at - 1].astype(np.int32) * self.size + across[at]]
        # Over the rows: doubling steps until each has the function of all rows before it.
        total, step = scanned[-1].copy(), 1
        while step < rows:
            total[step:] = self.compose[total[:-step].astype(np.int32) * self.size + total[step:]]
            step *= 2
        entry = np.full(rows, state, np.uint8)
        entry[1:] = self.apply[total[:-1], state]
        before = np.empty((WIDTH, rows), np.uint8)
        before[0] = entry
        before[1:] = self.apply[scanned[:-1], entry]
        all_before = before.T.reshape(-1)[: len(symbol)]
        return all_before, int(self.following[symbol[-1], all_before[-1]])

    def bounds(self, joined: str, ends: np.ndarray) -> np.ndarray:
        """Positions where a token begins or a text ends; ``ends`` are those of the separators."""
        found, state = [np.zeros(0, np.int64)], FRESH
        for at in range(0, len(joined), WINDOW):
            # A symbol depends on the two code points after its own at most.
            points = np.frombuffer(joined[at : at + WINDOW + 2].encode("utf-32-le"), np.uint32)
            size = min(WINDOW, len(joined) - at)
            inside = ends[np.searchsorted(ends, at) : np.searchsorted(ends, at + len(points))] - at
            symbol = self.symbols(points, inside)[:size]
            before, state = self.states(symbol, state)
            mark = self.begins[symbol, before]
            mark[inside[inside < size]] = True
            found.append(np.flatnonzero(mark) + at)
        return np.concatenate(found)


def pair_base(ranks: dict[bytes, int]) -> int:
    return max(ranks.values()) + 2


def pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that make another one, as numbers in ascending order, and its rank."""
    base = pair_base(ranks)
    merged = {
        ranks[token[:i]] * base + ranks[token[i:]]: rank
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    }
    keys = sorted(merged)
    return np.array(keys, np.int64), np.array([merged[k] for k in keys], np.int32)


class Merger:
    """Ids of pieces of text: cached, and merged many at a time."""

    def __init__(self, ranks: dict[bytes, int], keys: np.ndarray, ids: np.ndarray) -> None:
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.base = pair_base(ranks)
        # Open addressing, all keys of a round at once.
        self.bits = max(1, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.slot_ids = np.full(1 << self.bits, NO_PAIR, np.int32)
        left, at = np.arange(len(keys)), self._hash(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[left[free]]
            self.slot_ids[at[free]] = ids[left[free]]
            stay = self.slots[at] != keys[left]
            left, at = left[stay], (at[stay] + 1) & ((1 << self.bits) - 1)
        self._forget()

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _forget(self) -> None:
        self.cache: dict[str, int] = {}
        self.pool, self.start, self.count = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.pieces = self.used = 0

    def pair_ids(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id a pair merges to, NO_PAIR if it doesn't."""
        shape = left.shape
        keys = (left.astype(np.int64) * self.base + right).ravel()
        keys[(left < 0).ravel() | (right < 0).ravel()] = -2
        at = self._hash(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.slot_ids[at], NO_PAIR)
        open_ = np.flatnonzero((found != keys) & (found >= 0) & (keys >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.slots[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_ids[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out.reshape(shape)

    def merge_rows(self, raw: np.ndarray) -> np.ndarray:
        """Ids of byte strings of one length, one per row, filled up with -1."""
        ids = self.byte[raw]
        out = np.full(ids.shape, -1, np.int32)
        rows = np.arange(len(ids))
        while len(rows) and ids.shape[1] > 1:
            pairs = self.pair_ids(ids[:, :-1], ids[:, 1:])
            at = pairs.argmin(axis=1)
            lowest = pairs[np.arange(len(rows)), at]
            done = lowest == NO_PAIR
            out[rows[done], : ids.shape[1]] = ids[done]
            ids, rows, at, lowest = ids[~done], rows[~done], at[~done], lowest[~done]
            if len(rows):
                places = np.arange(ids.shape[1] - 1)
                shifted = np.take_along_axis(ids, places + (places > at[:, None]), axis=1)
                shifted[np.arange(len(rows)), at] = lowest
                ids = shifted
        out[rows, : ids.shape[1]] = ids
        return out

    def merge_long(self, raw: bytes) -> list[int]:
        """Ids of one long byte string: the pairs wait in a heap, lowest rank and place first."""
        ids = self.byte[np.frombuffer(raw, np.uint8)].tolist()
        lookup = self.ranks
        parts: list[bytes | None] = [raw[i : i + 1] for i in range(len(raw))]
        behind, ahead = list(range(-1, len(raw) - 1)), list(range(1, len(raw) + 1))
        heap = [(lookup[a + b], i, a + b) for i, (a, b) in enumerate(pairwise(parts)) if a + b in lookup]
        heapq.heapify(heap)
        while heap:
            rank, i, whole = heapq.heappop(heap)
            j = ahead[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j], ids[i] = whole, None, rank
            ahead[i] = ahead[j]
            if ahead[j] < len(parts):
                behind[ahead[j]] = i
            for a, b in ((behind[i], i), (i, ahead[i])):
                if a >= 0 and b < len(parts) and parts[a] + parts[b] in lookup:
                    heapq.heappush(heap, (lookup[parts[a] + parts[b]], a, parts[a] + parts[b]))
        return [ids[i] for i, part in enumerate(parts) if part is not None]

    def _put(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Append pieces with their ids, one after the other, to the pool."""
        need, total = self.pieces + len(pieces), self.used + len(ids)
        grow = lambda a, n: a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])
        self.pool, self.start, self.count = grow(self.pool, total), grow(self.start, need), grow(self.count, need)
        self.pool[self.used : total] = ids
        self.count[self.pieces : need] = counts
        self.start[self.pieces : need] = self.used + np.cumsum(counts) - counts
        self.cache.update(zip(pieces, range(self.pieces, need), strict=True))
        self.pieces, self.used = need, total

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        if self.pieces > CACHED:
            self._forget()
        new = set(pieces).difference(self.cache)
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            raw = piece.encode()
            if raw in self.ranks:
                by_length.setdefault(0, []).append((piece, raw))
            else:
                by_length.setdefault(min(len(raw), LONGEST_ROW + 1), []).append((piece, raw))
        for length, found in by_length.items():
            names = [piece for piece, _ in found]
            if length == 0:
                self._put(names, np.array([self.ranks[raw] for _, raw in found], np.int32), np.ones(len(found), np.int32))
            elif length <= LONGEST_ROW:
                raw = np.frombuffer(b"".join(raw for _, raw in found), np.uint8).reshape(len(found), length)
                rows = self.merge_rows(raw)
                real = rows >= 0
                self._put(names, rows[real], real.sum(axis=1).astype(np.int32))
            else:
                for piece, raw in found:
                    ids = self.merge_long(raw)
                    self._put([piece], np.array(ids, np.int32), np.array([len(ids)], np.int32))
        at = np.fromiter(map(self.cache.__getitem__, pieces), np.int64, len(pieces))
        counts = self.count[at].astype(np.int64)
        first = np.cumsum(counts) - counts
        ids = self.pool[np.repeat(self.start[at] - first, counts) + np.arange(int(counts.sum()))]
        for piece in new:
            if len(piece) > LONGEST_CACHED:
                del self.cache[piece]
        return ids, counts


class Encoder:
    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
        self.splitter, self.merger = Splitter(classes), Merger(ranks, keys, ids)
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and how many each has."""
        joined = "\0".join([*texts, ""])
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        bounds = self.splitter.bounds(joined, ends)
        places = bounds.tolist()
        pieces = [joined[a:b] for a, b in pairwise(places)]
        # The pieces that begin at a separator are the separators themselves.
        separators = np.searchsorted(bounds, ends)
        for at in separators[:-1].tolist():
            pieces[at] = ""
        kept = [p for p in pieces if p]
        ids, counts = self.merger.encode(kept)
        sums = np.r_[0, np.cumsum(counts)]
        upto = sums[separators - np.arange(len(texts))]
        return ids, np.diff(np.r_[0, upto])

    def step(self, column: pa.Array) -> list[pa.Array]:
        texts = [t or "" for t in column.to_pylist()]
        ids, counts, at = [], [], 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) < GROUP_CHARS:
                size += len(texts[end])
                end += 1
            got = self.group(texts[at:end])
            ids.append(got[0])
            counts.append(got[1])
            at = end
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        per_row = np.concatenate([np.zeros(0, np.int64), *counts])
        ends = np.cumsum(per_row)
        length = self.length[flat]
        passed = np.r_[0, np.cumsum(length)]
        offsets = passed[:-1] - np.repeat(passed[ends - per_row], per_row)
        rows = pa.array(np.r_[0, ends].astype(np.int32))
        return [pa.ListArray.from_arrays(rows, pa.array(flat)), pa.ListArray.from_arrays(rows, pa.array(offsets.astype(np.int32)))]


def encoder(ranks: dict[bytes, int]) -> Encoder:
    return Encoder(ranks, classes(), *pairs(ranks))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids array<int>`` and ``offsets array<int>``, the byte at which each token begins.

    Whole texts are encoded; a null or empty text has no ids. Text that looks like a special token
    is ordinary text. The vocabulary is read once by the driver and broadcast (a fixed size). Input
    columns (or ``keep`` of them) are kept, and replaced where they have the name of a new one. An
    empty table gives no rows, repeated rows are encoded each.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, classes(), *pairs(ranks)))

    def start() -> Step:
        return Encoder(*shared.value).step

    return add_columns(docs, start, "ids array<int>, offsets array<int>", [text], keep)


def decode(tokens: DataFrame, ranks: dict[bytes, int], keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded binary``: the bytes of ``ids``, put where ``offsets`` says.

    Null or empty ids decode to no bytes; an id that the vocabulary doesn't have has none.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def start() -> Step:
        size = max(shared.value.values()) + 2
        ordered = [b""] * size
        for token, rank in shared.value.items():
            ordered[rank] = token
        length = np.array([len(t) for t in ordered], np.int64)
        return partial(_decode, np.frombuffer(b"".join(ordered), np.uint8), length, np.cumsum(length) - length)

    return add_columns(tokens, start, "decoded binary", ["ids", "offsets"], keep)


def _decode(raw: np.ndarray, length: np.ndarray, begin: np.ndarray, ids: pa.Array, offsets: pa.Array) -> list[pa.Array]:
    per_row = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.where((flat >= 0) & (flat < len(length)), flat, len(length) - 1)
    sizes = length[flat]
    sums = np.r_[0, np.cumsum(sizes)]
    ends = np.cumsum(per_row)
    row_start = sums[ends - per_row]
    # A token's bytes go to its row's start and its own offset.
    to = np.repeat(row_start, per_row) + offsets.flatten().to_numpy(zero_copy_only=False)
    step = np.arange(int(sums[-1])) - np.repeat(sums[:-1], sizes)
    out = np.empty(int(sums[-1]), np.uint8)
    out[np.repeat(to, sizes) + step] = raw[np.repeat(begin[flat], sizes) + step]
    edges = np.r_[0, sums[ends]].astype(np.int32)
    return [pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(out.tobytes())])]


