"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before the library sees them, at a space or line feed that follows a character which is not
white space: no match of the pattern holds such a pair inside, and the pattern looks ahead only, so the
ids of the pieces are the ids of the whole. Ids decode to raw bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 1 << 16
"""Characters after which a text is cut at the next safe place."""

LONG_RUN = 1 << 15
"""Runs of white space from this length on are matched here: the library's matcher has a limit."""

_SAFE = regex.compile(r"(?<=\S)[ \n]")
_LONG = regex.compile(r"\s{%d}" % LONG_RUN)


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, kept by each worker."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def pieces(text: str) -> Iterator[str]:
    """The text in pieces whose ids are the ids of the whole."""
    at = 0
    while len(text) - at > PIECE:
        cut = _SAFE.search(text, at + PIECE)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str | None, ranks: str, pattern: str) -> np.ndarray:
    """The ids of a whole text, none of them special; null counts as empty."""
    bpe = encoding(ranks, pattern)
    parts = []
    for piece in pieces(text or ""):
        if len(piece) >= LONG_RUN and _LONG.search(piece):
            for match in regex.finditer(pattern, piece):
                parts.append(np.array(bpe._encode_single_piece(match.group()), np.uint32))
        else:
            parts.append(bpe.encode_to_numpy(piece, disallowed_special=()))
    return np.concatenate(parts)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([*rows, np.zeros(0, np.int32)]))


def encoded(text: Column, ranks: str, pattern: str) -> Column:
    """A column of each text's ids; null counts as empty, which has none. Texts of any length are whole; equal texts have equal ids."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _lists([encode(t.as_py(), ranks, pattern).astype(np.int32) for t in texts])

    return ids(F.coalesce(text.cast("string"), F.lit("")))


def decoded(ids: Column, ranks: str, pattern: str) -> Column:
    """A column of the raw bytes of each row of ids; null counts as no ids. An id outside the vocabulary is an error."""

    @F.arrow_udf("binary")
    def raw(rows: pa.Array) -> pa.Array:
        bpe = encoding(ranks, pattern)
        return pa.array([bpe.decode_bytes(row.values.to_numpy().tolist() if row.is_valid else []) for row in rows], pa.binary())

    return raw(ids)


def round_trip(text: Column, ranks: str, pattern: str) -> Column:
    """A struct of each text's ids and of the raw bytes that they decode to, with each text encoded once; null counts as empty."""

    @F.arrow_udf("struct<ids:array<int>,bytes:binary>")
    def both(texts: pa.Array) -> pa.Array:
        bpe = encoding(ranks, pattern)
        rows = [encode(t.as_py(), ranks, pattern) for t in texts]
        raw = pa.array([bpe.decode_bytes(row.tolist()) for row in rows], pa.binary())
        return pa.StructArray.from_arrays([_lists([row.astype(np.int32) for row in rows]), raw], names=["ids", "bytes"])

    return both(F.coalesce(text.cast("string"), F.lit("")))
