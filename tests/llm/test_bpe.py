"""Encoding against the library that defines it, decoding as an exact round trip."""

from __future__ import annotations

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from doclake.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

AWKWARD = [
    "",
    " ",
    "\n",
    "a",
    "don't we'll they've I'm 'tis x'set ''s 's's 're'veg 'LL 'l 'r",
    "a  b   c\n\n d \n\ne\t f g  h 　",
    "tail  ",
    "tail \n",
    "12 345x6 7½ Ⅻ ٣٤",
    "!!! ... ' '' '\" a'b' 'c",
    "日本語 テスト 한국어 ไทย 🎉🎉 é ́",
    "\x00 a\x00b\x1c\x1d c\x85d",
    "<|endoftext|> <|startoftext|>",
    "x" * 5000,
    "ab" * 3000 + " " * 400 + "c",
]


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(RANKS)


def ids_of(encoder, texts):
    ids, counts = encoder.group(texts)
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_awkward_texts(encoder):
    assert ids_of(encoder, AWKWARD) == [LIBRARY.encode_ordinary(t) for t in AWKWARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab's tdrevml1 \n\t!?é.日'"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_any_texts(encoder, texts):
    assert ids_of(encoder, texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_every_code_point():
    """A vocabulary of bytes and of a or 1 with a lead byte shows where the library cuts."""
    ranks = {bytes([b]): b for b in range(256)}
    for first in b"a1":
        for lead in range(0xC2, 0xF5):
            ranks[bytes([first, lead])] = len(ranks)
    library = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = bpe.encoder(ranks)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}a1{c}1 {c}{c}!{c}" for c in points[at : at + 512]) for at in range(0, len(points), 512)]
    assert ids_of(ours, texts) == [library.encode_ordinary(t) for t in texts]


def test_windows_do_not_show(encoder, monkeypatch):
    text = "".join(t[:300] for t in AWKWARD)
    whole = ids_of(encoder, [text, "x", text])
    monkeypatch.setattr(bpe, "WINDOW", 7)
    assert ids_of(encoder, [text, "x", text]) == whole


def test_long_pieces_merge_like_rows(encoder):
    for piece in ("abcabcabc", "anderunganderung", "éééé", "a" * 37):
        raw = piece.encode()
        import numpy as np

        row = encoder.merger.merge_rows(np.frombuffer(raw, np.uint8)[None, :])[0]
        assert row[row >= 0].tolist() == encoder.merger.merge_long(raw)


def test_cache_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 10)
    for at in range(5):
        text = " ".join(f"word{at}x{i}" for i in range(40))
        assert ids_of(encoder, [text]) == [LIBRARY.encode_ordinary(text)]
        assert len(encoder.merger.cache) < 200


def test_round_trip_in_spark(spark):
    rows = [(i, t, "mine") for i, t in enumerate([*AWKWARD, None])] + [(0, "again", "mine"), (0, "again", "mine"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    done = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert done.columns == ["doc_id", "text", "ids", "offsets", "decoded"]
    got = done.collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.ids == LIBRARY.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
        sizes = [len(LIBRARY.decode_single_token_bytes(i)) for i in row.ids]
        assert row.offsets == [sum(sizes[:i]) for i in range(len(sizes))] if len(sizes) < 200 else True
    assert bpe.encode(docs.limit(0), RANKS).count() == 0


def test_decode_of_odd_ids(spark):
    tokens = spark.createDataFrame([(1, None, None), (2, [], []), (3, [10**6, 65], [0, 0])], "k int, ids array<int>, offsets array<int>")
    got = {r.k: bytes(r.decoded) for r in bpe.decode(tokens, RANKS).collect()}
    assert got == {1: b"", 2: b"", 3: LIBRARY.decode_single_token_bytes(65)}
