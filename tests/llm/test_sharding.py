from __future__ import annotations

import zlib
from collections import Counter
from random import Random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermend.llm import sharding
from ledgermend.llm.sharding import communication_matrix, hypergeometric, shard_rows


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 500), st.integers(0, 500), st.data())
def test_draws_are_possible(good, bad, data):
    draws = data.draw(st.integers(0, good + bad))
    got = hypergeometric(Random(data.draw(st.integers(0, 9))), good, bad, draws)
    assert max(0, draws - bad) <= got <= min(good, draws)


def test_draws_follow_the_law():
    from math import comb

    random, n = Random(3), 20_000
    seen = Counter(hypergeometric(random, 7, 9, 6) for _ in range(n))
    for k in range(7):
        want = n * comb(7, k) * comb(9, 6 - k) / comb(16, 6)
        assert abs(seen[k] - want) < 5 * want**0.5 + 5
    large = [hypergeometric(random, 10**9, 10**9, 10**8) for _ in range(20)]
    assert all(abs(x - 5 * 10**7) < 6 * 4800 for x in large) and len(set(large)) > 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=8), st.integers(1, 6))
def test_matrix_has_the_sizes_of_both_sides(blocks, shards):
    total = sum(blocks)
    targets = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix(blocks, targets, 1)
    assert [sum(row) for row in matrix] == blocks
    assert [sum(column) for column in zip(*matrix, strict=True)] == targets


def check(rows, documents, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in documents
    )
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(j, ())) for j in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))


@pytest.mark.parametrize("piece", [100_000, 3])
def test_odd_rows(odd, odd_rows, none, monkeypatch, piece):
    monkeypatch.setattr(sharding, "PIECE_ROWS", piece)
    documents = [(r[0], r[1]) for r in odd_rows]
    first = shard_rows(odd, 16).collect()
    check(first, documents, 16)
    again = shard_rows(odd.repartition(2), 16).collect()
    assert sorted(first, key=str) == sorted(again, key=str)
    assert sorted(shard_rows(odd, 16, seed=1).collect(), key=str) != sorted(first, key=str)
    assert shard_rows(none, 16).collect() == []


def test_places_are_uniform(spark):
    """Over many rows, doc_id says nothing about shard or slot."""
    n, shards = 16_000, 16
    rows = shard_rows(spark.range(n).selectExpr("id as doc_id", "'same' as text"), shards).collect()
    check(rows, [(k, "same") for k in range(n)], shards)
    for part in (lambda r: r.doc_id // 1000, lambda r: r.doc_id % 16):
        table = Counter((part(r), r.shard) for r in rows)
        square = sum((table[a, b] - 62.5) ** 2 / 62.5 for a in range(16) for b in range(16))
        assert 130 < square < 340  # 225 degrees of freedom
    halves = Counter((r.doc_id < n // 2, r.slot < 500) for r in rows)
    assert all(abs(v - n / 4) < 250 for v in halves.values())


def test_no_python_in_the_plan(odd):
    plan = shard_rows(odd, 16)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
