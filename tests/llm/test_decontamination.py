"""Decontamination against brute force."""

from __future__ import annotations

import random
import re

import pytest
from conftest import prose

from ledgermend.llm import decontamination
from ledgermend.llm.decontamination import contamination, without_documents, without_spans

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEMS = "item_id long, text string, words string, n int, hash long, items string"


def lower(text):
    return re.sub("[A-Z]", lambda c: c.group().lower(), text or "")


def words(text):
    return re.findall(LETTERS, lower(text))


def brute(texts: list, items: list[tuple], width: int = 10) -> list[tuple]:
    grams: dict = {}
    for item_id, text in items:
        own = words(text)
        n = min(width, len(own))
        for k in range(len(own) - n + 1) if own else ():
            grams.setdefault(tuple(own[k : k + n]), set()).update([] if item_id is None else [str(item_id)])
    out = []
    for text in texts:
        own, inside, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in grams:
                    inside.update(range(k, k + n))
                    found |= grams[tuple(own[k : k + n])]
        out.append((len(own), inside, sorted(found)))
    return out


@pytest.fixture(scope="module")
def items(odd_rows):
    passage = words(odd_rows[0][1])
    rows = [
        (1, " ".join(passage[20:45])),
        (2, "x, ".join([]) + " ".join(passage[40:60]).upper()),
        (3, " ".join(passage[100:107])),  # shorter than a window
        (4, "general -- public: LICENSE"),
        (5, "nowhere in any text at all these words stand so close together"),
        (6, None),
        (7, " .,! "),
        (8, "漢字 🙂 x85"),
        (1, " ".join(passage[200:215])),  # one id, another text
        (None, " ".join(passage[300:312])),
        (9, " ".join(passage[20:45])),  # an equal text
        (10, "again again again"),
    ]
    rows += [(100 + k, f"{k} " + " ".join(passage[150:162])) for k in range(30)]  # a passage of many items
    return rows


@pytest.fixture(scope="module")
def benchmark_rows(spark, items):
    return spark.createDataFrame([(*r, "w", 1, 2, "i") for r in items], ITEMS)


@pytest.mark.parametrize("most", [1 << 21, 0])
@pytest.mark.parametrize("width", [10, 3])
def test_odd_rows(spark, odd, odd_rows, benchmark_rows, items, monkeypatch, most, width):
    """Windows in a broadcast set, and joined by a shuffle."""
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", most)
    got = contamination(odd, benchmark_rows, width).collect()
    want = brute([r[1] for r in odd_rows], items, width)
    shown = sorted((str(r.doc_id), r.n_words, r.n_hit, str(r["items"])) for r in got)
    assert shown == sorted((str(row[0]), n, len(inside), str(found)) for row, (n, inside, found) in zip(odd_rows, want, strict=True))
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in got if r.doc_id is not None}
    for row, (_, inside, _) in zip(odd_rows, want, strict=True):
        if row[0] is not None:
            assert {k for a, b in spans[row[0]] for k in range(a, b)} == inside
            assert all(b < c for (_, b), (c, _) in zip(spans[row[0]], spans[row[0]][1:], strict=False))


def test_empty_tables(spark, odd, odd_rows, none, benchmark_rows):
    assert contamination(none, benchmark_rows).collect() == []
    clean = contamination(odd, benchmark_rows.where("false")).collect()
    assert len(clean) == len(odd_rows) and all(r.n_hit == 0 and r["items"] == [] and r.spans == [] for r in clean)


def test_removal(spark, odd, odd_rows, benchmark_rows, items):
    found = contamination(odd, benchmark_rows)
    want = brute([r[1] for r in odd_rows], items)
    left = without_documents(odd, found)
    assert left.columns == odd.columns
    assert sorted(str(r.text) for r in left.collect()) == sorted(str(row[1]) for row, w in zip(odd_rows, want, strict=True) if not w[1])
    cut = without_spans(odd, found)
    assert cut.columns == odd.columns and cut.count() == len(odd_rows)
    kept = sorted(str(words(r.text)) for r in cut.collect())
    assert kept == sorted(str([word for k, word in enumerate(words(row[1])) if k not in w[1]]) for row, w in zip(odd_rows, want, strict=True))
    untouched = {str(row[1]) for row, w in zip(odd_rows, want, strict=True) if not w[1]}
    assert untouched <= {str(r.text) for r in cut.collect()}


def test_a_passage_of_many_documents(spark):
    passage, chooser = prose(77, 60), random.Random(1)
    texts = [f"{prose(k, 30)} {passage}" if k % 3 else prose(k, chooser.randrange(90)) for k in range(120)] + [passage] * 80
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(k, passage if k % 2 else prose(500 + k, 20)) for k in range(40)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in contamination(docs, bench).collect()}
    want = brute(texts, [(r.item_id, r.text) for r in bench.collect()])
    assert got == {k: (n, len(inside), found) for k, (n, inside, found) in enumerate(want)}


def test_no_python_in_the_plan(odd, benchmark_rows):
    found = contamination(odd, benchmark_rows)
    for frame in (found, without_spans(odd, found), without_documents(odd, found)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
