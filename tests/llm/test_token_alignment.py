"""Token alignment against both libraries on whole texts."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermend.llm import token_alignment
from ledgermend.llm.token_alignment import Aligned, aligner, alignments, exact_ends

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FRESH_A, FRESH_B = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
FRESH_A.encode_special_tokens = True
PARTS = st.sampled_from([" ", "  ", "\n", "\t", "a", "b", "word", "Hello", "🙂", "é", "漢", "\x1c", "\x85", "\xa0", "\u3000", "1", "23", "'s", "!", "<s>", "<|endoftext|>", "\x00", "ß", "\u200b", "\u0301", "don't", "▁", "."])


def byte_table() -> dict[str, int]:
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


LETTERS = byte_table()
BYTES_A = {n: bytes(LETTERS.get(c, 0) for c in entry) for entry, n in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}


def piece_bytes(number: int) -> bytes:
    piece = FRESH_B.id_to_piece(number)
    return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") else piece.replace("▁", " ").encode()


def brute(text: str | None) -> tuple[int, int, str, list[tuple[int, int]]]:
    """(tokens of A, of B, groups, links) byte by byte."""
    if not text:
        return 0, 0, "", []
    a, b = FRESH_A.encode(" " + text, add_special_tokens=False).ids, FRESH_B.encode(text, num_threads=1)
    sides = [[BYTES_A[n] for n in a], [piece_bytes(n) for n in b]]
    if any(b"".join(side) != (" " + text).encode() for side in sides):
        return 0, 0, "", []
    owner = [[k for k, token in enumerate(side) for _ in token] for side in sides]
    links = list(dict.fromkeys(zip(*owner, strict=True)))
    ends = [set(np.cumsum(list(map(len, side))).tolist()) for side in sides]
    groups, start = [], 0
    for cut in sorted(ends[0] & ends[1]):
        groups.append("|".join(",".join(str(ids[k]) for k in dict.fromkeys(own[start:cut])) for ids, own in zip((a, b), owner, strict=True)))
        start = cut
    return len(a), len(b), ";".join(groups), [(a[i], b[j]) for i, j in links]


def shown(found: Aligned) -> tuple:
    pairs = np.frombuffer(found.links, "<i8")
    return found.n_a, found.n_b, found.groups, [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs]


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_any_mixture(text):
    found = aligner(A, B).align([text])[0]
    assert shown(found) == brute(text)
    assert found.n_groups == (found.groups.count("|")) and found.n_links == len(found.links) // 8


def test_texts_that_stay_whole(monkeypatch):
    """A vocabulary whose entries join words has its texts aligned without cuts."""
    whole = token_alignment.Aligner(A, B)
    assert whole.by_word
    whole.by_word = False
    for text in ("two words  here ", "é漢 🙂\n\nx", " ", "x" * 50):
        assert shown(whole.align([text])[0]) == brute(text)


def test_ends_inside_a_character():
    """Three tokens for the three bytes of one character behind an ASCII one: the spans have one end in common."""
    assert exact_ends(10, [1, 4, 4, 4, 5], [1, 1, 1, 1, 1]) == [11, 12, 13, 14, 15]


def counted(rows: list[tuple]) -> dict:
    found = [brute(text) for _, text in rows]
    counts = Counter(pair for f in found for pair in f[3])
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return {
        (doc_id, f[0], f[1], f[2].count("|"), len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]), f[2])
        for (doc_id, _), f in zip(rows, found, strict=True)
    }


@pytest.mark.parametrize("block", [1 << 22, 2000])
def test_odd_rows(odd, odd_rows, none, monkeypatch, block):
    """One block a partition, and many."""
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    got = alignments(odd, A, B).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert len(got) == len(odd_rows) and {tuple(r[n] for n in names) for r in got} == counted([r[:2] for r in odd_rows])
    assert alignments(none, A, B).collect() == []


def test_the_query(spark, data_root):
    from ledgermend.llm.queries import QUERIES

    where = str(data_root / "sf0.001")
    got = {tuple(r[:7]) + (r.groups_sha256,) for r in QUERIES["op13_token_alignment"](spark, where).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    assert got == {(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in counted(rows)}
