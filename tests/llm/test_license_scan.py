from __future__ import annotations

import re

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermend.llm.license_scan import BASE_NOTICES, MORE_NOTICES, Scanner, scan_notices, words_of

ALL = BASE_NOTICES + MORE_NOTICES


def words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base_places(text: str | None) -> list[tuple[int, str]]:
    found, own = [], words(text)
    for notice in BASE_NOTICES:
        phrase = notice.phrase.split(" ")
        found += [(k, notice.label) for k in range(len(own)) if own[k : k + len(phrase)] == phrase]
    return sorted(found)


def fuzzy_labels(text: str | None) -> set[str]:
    """Labels by a search of the whole text, without seeds."""
    joined = f" {' '.join(words(text))} "
    return {n.label for n in ALL if regex.search(rf"(?<= )(?:{regex.escape(n.phrase, special_only=True)}){{e<={n.errors}}}(?= )", joined)}


def exact(spans) -> list[tuple[int, str]]:
    phrases = {n.phrase for n in BASE_NOTICES}
    return sorted((s["word"], s["label"]) for s in spans if not s["edits"] and s["found"] in phrases)


def test_odd_rows(odd, odd_rows):
    got = scan_notices(odd).collect()
    assert len(got) == len(odd_rows)
    texts = {row[0]: row[1] for row in odd_rows}
    for row in got:
        if row.doc_id is not None:
            text = texts[row.doc_id]
            assert row.n_words == len(words(text))
            assert exact(row.spans) == base_places(text)
            assert {s.label for s in row.spans} == fuzzy_labels(text)


def test_no_rows(none):
    assert scan_notices(none).collect() == []


def test_edits_are_found_and_reported():
    spans = Scanner(ALL).spans(" under the gnu genral publik license and all right reserved ")
    assert [(s["label"], s["edits"], s["word"], s["found"]) for s in spans] == [
        ("gpl", 2, 3, "genral publik license"),
        ("reserved", 1, 7, "all right reserved"),
    ]
    assert Scanner(ALL).spans(" cc byte all lefts conserved license public general ") == []


PARTS = ["all", "rights", "reserved", "rigths", "al", "general", "public", "license", "publc", "cc", "by", "x", "Reserved.", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map(" ".join))
def test_seeds_lose_nothing(text):
    joined = f" {b' '.join(words_of(text)).decode()} "
    spans = Scanner(ALL).spans(joined)
    assert exact(spans) == base_places(text)
    assert {s["label"] for s in spans} == fuzzy_labels(text)
    own = joined.split()
    for s in spans:
        assert " ".join(own[s["word"] : s["word"] + s["n_words"]]) == s["found"]
