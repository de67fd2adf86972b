from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermend.llm import jaccard_join
from ledgermend.llm.jaccard_join import Trie, jaccard_components, prefix_length, reaches
from ledgermend.llm.shingling import shingle_hashes, shingle_sets, word_hashes


def shingles(text: str | None, width: int) -> set:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute_components(rows: list[tuple], width: int, percent: int) -> dict:
    """doc_id to (sizes, component) over all pairs."""
    sets = [(row[0], shingles(row[1], width)) for row in rows]
    ids = {doc_id for doc_id, _ in sets if doc_id is not None}
    component = {doc_id: doc_id for doc_id in ids}
    links = [
        (a, b)
        for k, (a, s) in enumerate(sets)
        for b, t in sets[:k]
        if None not in (a, b) and s and t and reaches(len(s & t), len(s), len(t), percent)
    ]
    for _ in ids:
        for a, b in links:
            component[a] = component[b] = min(component[a], component[b])
    return component


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_components_of_odd_rows(odd, odd_rows, width, percent):
    got = jaccard_components(odd, width, percent).collect()
    assert len(got) == len(odd_rows)
    want = brute_components(odd_rows, width, percent)
    sizes = {row[0]: len(shingles(row[1], width)) for row in odd_rows}
    for row in got:
        if row.doc_id is not None:
            assert (row.n_shingles, row.component_id) == (sizes[row.doc_id], want[row.doc_id])
    nameless = sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None and r.component_id is not None)
    assert nameless == [(len(shingles(odd_rows[0][1], width)), 0)]  # the text of document 0


def test_no_rows(none):
    assert jaccard_components(none, 3, 90).collect() == []


def test_a_large_group_of_near_copies_and_chains(spark):
    """Copies of one text link through it; a chain of small steps links its ends."""
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(60):  # one word apart from the base, at different places
        words = list(base)
        words[5 * k] = f"other{k}"
        texts.append(" ".join(words))
    chain = [f"v{k}" for k in range(200)]
    for k in range(12):
        texts.append(" ".join(chain[: 200 - 3 * k]))
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)
    assert set(got.values()) == {0, 60}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 30), min_size=1, max_size=25), min_size=1, max_size=12), st.frozensets(st.integers(0, 30), min_size=1), st.sampled_from([50, 80, 90]))
def test_trie_finds_what_all_pairs_find(sets, probe, percent):
    arrays = [(k, np.array(sorted(s), np.uint64)) for k, s in enumerate(sets)]
    got = dict(Trie(arrays).linked(np.array(sorted(probe), np.uint64), percent))
    want = {k: len(s & probe) for k, s in enumerate(sets) if reaches(len(s & probe), len(s), len(probe), percent)}
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.frozensets(st.integers(0, 60), min_size=1, max_size=50), st.frozensets(st.integers(0, 60), min_size=1, max_size=50), st.sampled_from([80, 90]))
def test_similar_sets_share_a_prefix_key(a, b, percent):
    if reaches(len(a & b), len(a), len(b), percent):
        first = [set(sorted(s)[: prefix_length(len(s), percent)]) for s in (a, b)]
        assert first[0] & first[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \t\n\x0bé漢\x1c", max_size=40)), max_size=8))
def test_word_hashes_are_those_of_words(texts):
    column = pa.array(texts, pa.string())
    hashes, at = word_hashes(column)
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[AB]", lambda m: m.group().lower(), t or "")) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat, strict=True)}) == len(set(flat))
    assert [len(s) for s in shingle_sets(column, 3)] == [len(shingles(t, 3)) for t in texts]
    assert len(shingle_hashes(column, 3)) == sum(max(0, len(w) - 2) for w in words)


def test_words_longer_than_a_window(monkeypatch):
    monkeypatch.setattr("ledgermend.llm.shingling.WINDOW", 16)
    texts = ["ab" * 40 + " cd", "x" * 16, " " * 50, "a b c d e f g h i j k l m n o p", "", "y" * 33]
    hashes, at = word_hashes(pa.array(texts))
    monkeypatch.undo()
    plain, plain_at = word_hashes(pa.array(texts))
    assert hashes.tolist() == plain.tolist() and at.tolist() == plain_at.tolist()


def _near(seed: int, n: int, words: int, changed: int) -> list[str]:
    chooser = random.Random(seed)
    base = [f"b{seed}w{k}" for k in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for place in chooser.sample(range(words), changed):
            own[place] = f"x{seed}y{k}z{place}"
        out.append(" ".join(own))
    return out


def test_rows_sent_for_a_large_cluster(spark, monkeypatch):
    """2,400 near copies are compared with their probe, and none of them meets the others in blocks."""
    sent = []
    plain = jaccard_join.joined_in_clusters

    def counted(members, percent):
        sent.append(members.agg(F.sum(F.col("blocks") + 1)).first()[0] or 0)
        return plain(members, percent)

    monkeypatch.setattr(jaccard_join, "joined_in_clusters", counted)
    rows = list(enumerate([" ".join(f"b5w{k}" for k in range(120))] + _near(5, 2399, 120, 1)))
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 90).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 2400
    assert sent == [0]


def test_a_cluster_above_a_block_in_several_parts(spark, monkeypatch):
    """Copies too unlike for their probe meet in blocks, with each other and with the largest part."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    texts = _near(1, 40, 100, 1) + _near(1, 60, 100, 5)
    far = texts[70].split(" ")
    texts += [" ".join([*far[:50], f"link{k}", *far[51:]]) for k in range(25)]  # near one of the unlike copies
    rows = list(enumerate(texts))
    random.Random(2).shuffle(rows)
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)
    assert 3 < len(set(got.values())) < 100
