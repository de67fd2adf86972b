"""Byte-level BPE, word BPE, files of ids, and packing."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermend.llm import packing
from ledgermend.llm.byte_bpe import PIECE, decoded, encode, encoded, encoding, pieces, round_trip
from ledgermend.llm.files import MANIFEST, filesystem
from ledgermend.llm.packing import cheapest_cuts, pack, places
from ledgermend.llm.pfor import BLOCK, Reader, Writer, pack_block, read_ids, unpack_block, write_ids
from ledgermend.llm.store import new_path
from ledgermend.llm.word_bpe import Generations, JointGenerations, word_bpe

RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
WORDS = public_tokenizers.path("word_bpe_49k.json")
PLAIN = tokenizers.Tokenizer.from_file(WORDS)
ANY = st.text(alphabet=st.sampled_from("abzABZ019 '\n\t.,!stremvl’éÉßÀÿ÷×µªº ́\x1cİıΣς漢🙂<|>\x85 "), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ANY)
def test_byte_bpe_is_the_librarys(text):
    ids = encode(text, *RANKS)
    assert ids.tolist() == encoding(*RANKS).encode_ordinary(text)
    assert encoding(*RANKS).decode_bytes(ids.tolist()) == text.encode()


def test_long_texts_are_cut_safely():
    bpe = encoding(*RANKS)
    for text in ("some words  here,\n\nand 'll there \t" * 9000, "a" * 300_000, " \n" * 100_000 + "x", "a  b\n" * 60_000):
        cut = list(pieces(text))
        assert "".join(cut) == text and (len(text) <= PIECE or len(cut) > 1 or "a  b" not in text)
        assert encode(text, *RANKS).tolist() == bpe.encode_ordinary(text)
    run = "x" + " " * 1_200_000 + "y"  # beyond what the library's matcher takes
    assert bpe.decode_bytes(encode(run, *RANKS).tolist()) == run.encode()


def test_byte_bpe_columns(odd, odd_rows, none):
    ids = odd.select("doc_id", "text", encoded(F.col("text"), *RANKS).alias("ids"))
    rows = ids.select("*", decoded(F.col("ids"), *RANKS).alias("raw")).collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        assert bytes(row.raw) == (row.text or "").encode()
        assert row.ids == encode(row.text, *RANKS).tolist()
    assert none.select(encoded(F.col("text"), *RANKS)).collect() == []


@settings(max_examples=300, deadline=None)
@given(ANY)
def test_word_bpe_is_the_librarys(text):
    bpe = word_bpe(WORDS)
    assert bpe.encode(text).tolist() == bpe.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_bpe_of_odd_texts(odd_rows):
    bpe = word_bpe(WORDS)
    for row in odd_rows:
        assert bpe.encode(row[1]).tolist() == bpe.tokenizer.encode(row[1] or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(5, 9)), min_size=1, max_size=300))
def test_blocks_round_trip(ids):
    assert unpack_block(pack_block(np.array(ids, np.uint32))).tolist() == ids


def test_outliers_do_not_widen_a_block():
    ids = np.array([100 + k % 8 for k in range(BLOCK)], np.uint32)
    plain = len(pack_block(ids))
    ids[::100] = 4_000_000_000
    assert len(pack_block(ids)) == plain + 41 * 6


def test_a_file_can_be_read_from_any_place():
    out = io.BytesIO()
    writer = Writer(out)
    documents = [(k if k % 5 else None, np.arange(k * 700 % 9001, dtype=np.uint32)) for k in range(60)]
    for doc_id, ids in documents:
        writer.add(doc_id, ids)
    writer.close()
    reader = Reader(pa.BufferReader(out.getvalue()))
    whole = np.concatenate([ids for _, ids in documents])
    assert reader.documents == [d for d, _ in documents] and reader.n_ids == len(whole)
    for start, end in ((0, 0), (0, len(whole)), (4095, 4097), (BLOCK, 2 * BLOCK), (77_777, 99_999), (len(whole) - 1, len(whole))):
        assert reader.ids(start, end).tolist() == whole[start:end].tolist()


def ids_of(text: str | None, end_id: int) -> list[int]:
    bpe = word_bpe(WORDS)
    return [*bpe.tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]


def test_files_of_odd_rows(spark, odd, odd_rows, none):
    uri = new_path(spark, "ids-test")
    write_ids(odd, uri, WORDS, end_id=2)
    rows = read_ids(spark, uri).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r[0] for r in odd_rows), key=lambda d: -1 if d is None else d)
    texts: dict = {}
    for row in odd_rows:
        texts.setdefault(row[0], []).append(ids_of(row[1], 2))
    start = 0
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert (row.start, row.n_tokens) == (start, len(ids))
        texts[row.doc_id].remove(ids)
        start += len(ids)
    assert not any(texts.values())
    system, path = filesystem(uri)
    from pyarrow import fs

    names = {f.base_name for f in system.get_file_info(fs.FileSelector(path))}
    assert MANIFEST in names and not [n for n in names if n.endswith(".tmp")]
    empty = new_path(spark, "ids-test")
    write_ids(none, empty, WORDS, end_id=2)
    assert read_ids(spark, empty).collect() == []


@pytest.mark.parametrize("run", [1 << 19, 3000])
def test_packing_of_odd_rows(odd, odd_rows, none, monkeypatch, run):
    monkeypatch.setattr(packing, "RUN", run)
    length = 512
    rows = pack(odd, WORDS, end_id=1, length=length).collect()
    check_packing(rows, [(row[0], ids_of(row[1], 1)) for row in odd_rows], length)
    assert pack(none, WORDS, end_id=1).collect() == []


def check_packing(rows, documents, length: int) -> None:
    line = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    offset, sequence, order = 0, None, []
    for row in line:  # gapless sequences
        offset = offset if row.sequence_id == sequence else 0
        sequence = row.sequence_id
        assert row.offset == offset and row.length == len(row.ids) // 4 > 0
        offset += row.length
        assert offset <= length
    current: list[int] = []
    left: dict = {}
    for doc_id, ids in documents:
        left.setdefault(doc_id, []).append(ids)
    for row in line:  # documents follow one another whole, in order
        assert row.start == len(current)
        current += np.frombuffer(row.ids, "<u4").tolist()
        if len(current) == row.doc_tokens:
            left[row.doc_id].remove(current)
            order.append(row.doc_id)
            current = []
    assert not current and not any(left.values())
    assert order == sorted(order, key=lambda d: -1 if d is None else d)


def test_little_padding(spark):
    texts = [(k, " ".join(f"word{k * j % 977} river stone." for j in range(5 + k * 37 % 300))) for k in range(400)]
    rows = pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), WORDS, end_id=1).collect()
    sizes: dict[int, int] = {}
    for row in rows:
        sizes[row.sequence_id] = sizes.get(row.sequence_id, 0) + row.length
    padding = sum(0 if size & (size - 1) == 0 else 2048 - size for size in sizes.values())
    tasks = len({number >> 40 for number in sizes})
    assert padding - 2048 * tasks < 0.01 * sum(sizes.values())


def cost(cuts, at, costs, length) -> int:
    penalty = dict(zip(at.tolist(), costs.tolist(), strict=True))
    total = 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        size = b - a
        free = size & (size - 1) == 0 and packing.SHORTEST <= size < length
        total += penalty[b] + (0 if free else length - size)
    return total


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=14), st.lists(st.sampled_from([0, 3, 9]), min_size=14, max_size=14))
def test_plans_are_cheapest(gaps, penalties):
    length, packing.SHORTEST, before = 32, 4, packing.SHORTEST
    try:
        at = np.cumsum([0, *gaps])
        costs = np.array([0, *penalties[: len(gaps)]])
        costs[-1] = 0
        got = cheapest_cuts(at, costs, length).tolist()
        assert got[0] == 0 and got[-1] == at[-1] and max(np.diff(got)) <= length
        best = {0: 0}
        for j in range(1, len(at)):
            best[j] = min(best[i] + cost([int(at[i]), int(at[j])], at, costs, length) for i in range(j) if at[j] - at[i] <= length)
        assert cost(got, at, costs, length) == best[len(at) - 1]
    finally:
        packing.SHORTEST = before


def test_places_leave_no_long_gap():
    ids = np.zeros(1000, np.uint32)
    at, costs = places(ids, np.array([300, 1000]), np.zeros(1, bool))
    assert at[0] == 0 and at[-1] == 1000 and np.diff(at).max() <= packing.STEP
    assert costs[at == 300] == 0 and costs[at == 32] == packing.INNER_CUT


def test_ids_and_bytes_of_one_pass(odd, none):
    both = odd.select("text", round_trip(F.col("text"), *RANKS).alias("of"))
    for row in both.collect():
        assert bytes(row.of.bytes) == (row.text or "").encode() and row.of.ids == encode(row.text, *RANKS).tolist()
    plan = both.select(F.size("of.ids"), F.sha2("of.bytes", 256))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("both(") <= 2
    assert none.select(round_trip(F.col("text"), *RANKS)).collect() == []


def test_what_is_asked_for_often_is_remembered():
    asked = []
    memo = Generations(lambda key: asked.append(key) or len(key), 10)
    for k in range(300):
        assert memo["often"] == 5 and memo[f"once{k}"] == len(f"once{k}")
    assert asked.count("often") == 1 and len(asked) == 301 and len(memo) + len(memo.old) <= 20
    assert memo["x" * 1000] == 1000 and "x" * 1000 not in memo


def test_many_at_once_are_remembered():
    asked = []
    memo = JointGenerations(lambda keys: asked.extend(keys) or [key.encode() for key in keys], 10)
    for k in range(300):
        keys = ["often", f"once{k}", "often", "x" * 1000]
        assert memo.joined(keys) == "".join(keys).encode() and "x" * 1000 not in memo.young
    assert asked.count("often") == 1 and asked.count("x" * 1000) == 300 and len(asked) == 601
    assert len(memo.young) + len(memo.old) <= 24 and memo.joined([]) == b""


@settings(max_examples=200, deadline=None)
@given(st.lists(ANY, max_size=4), st.sampled_from([" ", "\n", "", "<|endoftext|>", "<|ENDOFTEXT|>"]))
def test_runs_of_plain_words_are_the_librarys(texts, between):
    text = between.join(texts)
    assert word_bpe(WORDS).encode(text).tolist() == PLAIN.encode(text, add_special_tokens=False).ids
