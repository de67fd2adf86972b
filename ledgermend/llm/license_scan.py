"""License scan: fuzzy search for short notices by exact seeds and bounded-error matching.

A text is read as its words, joined by single spaces. A notice that may have k errors is split into k + 1
pieces; at most k edits leave one piece intact, so one automaton over all pieces of all notices finds each
possible place exactly. Around a found piece the regex library matches the whole notice with at most k
edits, between word limits, and reports the span with the fewest.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Notice:
    """A short notice: words in lower case with single spaces, and the edits that it may have."""

    label: str
    phrase: str
    errors: int


#: The notices whose exact places are the base of the scan.
BASE_NOTICES = (
    Notice("cc-by", "cc by", 0),
    Notice("gpl", "general public license", 2),
    Notice("reserved", "all rights reserved", 2),
)
MORE_NOTICES = (
    Notice("apache", "licensed under the apache license", 3),
    Notice("apache", "apache license version 2 0", 2),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc", "creative commons attribution", 2),
    Notice("copyright", "copyright c", 0),
    Notice("mit", "permission is hereby granted free of charge", 4),
    Notice("mit", "released under the mit license", 2),
    Notice("mpl", "mozilla public license", 2),
    Notice("public-domain", "dedicated to the public domain", 2),
    Notice("spdx", "spdx license identifier", 2),
    Notice("unlicense", "free and unencumbered software", 2),
)

SPAN = pa.struct(
    [("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64()), ("length", pa.int64()), ("found", pa.string())]
)
SPAN_DDL = "array<struct<label:string,word:bigint,n_words:bigint,edits:bigint,length:bigint,found:string>>"

#: What is no part of a word becomes a space; A-Z become a-z; bytes of other scripts stay.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


@dataclass
class Scanner:
    notices: tuple[Notice, ...]
    seeds: ahocorasick.Automaton = field(init=False)
    patterns: list = field(init=False)

    def __post_init__(self):
        places: dict[str, list[tuple[int, int]]] = {}
        self.patterns = []
        for i, notice in enumerate(self.notices):
            # Without errors the word limits belong to the seed.
            whole = notice.phrase if notice.errors else f" {notice.phrase} "
            pieces = notice.errors + 1
            cuts = [len(whole) * k // pieces for k in range(pieces + 1)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                places.setdefault(whole[start:end], []).append((i, start - (not notice.errors)))
            self.patterns.append(regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice.phrase, special_only=True)}){{e<={notice.errors}}}(?= )"))
        self.seeds = ahocorasick.Automaton()
        for piece, of in places.items():
            self.seeds.add_word(piece, (len(piece), of))
        self.seeds.make_automaton()

    def spans(self, joined: str) -> list[dict]:
        """All spans in a text of words with a space around each, in order; of one notice, none overlap."""
        found: dict[int, dict[int, tuple[int, int]]] = {}
        tried = set()
        for end, (length, of) in self.seeds.iter(joined):
            for i, offset in of:
                begin = end + 1 - length - offset
                if (i, begin) in tried:
                    continue
                tried.add((i, begin))
                notice = self.notices[i]
                size = len(notice.phrase)
                spans = found.setdefault(i, {})
                if begin > 0 and joined.startswith(f" {notice.phrase} ", begin - 1):
                    spans[begin] = (0, begin + size)
                    continue
                low, high = max(0, begin - notice.errors), min(len(joined), begin + size + notice.errors + 1)
                match = self.patterns[i].search(joined, low, high) if notice.errors else None
                if match:
                    known = spans.get(match.start())
                    here = (sum(match.fuzzy_counts), match.end())
                    spans[match.start()] = min(known, here) if known else here
        out = []
        for i, spans in found.items():
            out += [(start, end, edits, i) for start, end, edits in _apart(spans)]
        out.sort()
        at = word = 0
        rows = []
        for start, end, edits, i in out:
            word += joined.count(" ", at, start)
            at = start
            notice = self.notices[i]
            rows.append({"label": notice.label, "word": word - 1, "n_words": joined.count(" ", start, end) + 1, "edits": edits, "length": len(notice.phrase), "found": joined[start:end]})
        return rows


def _apart(spans: dict[int, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, edits) of all exact spans, and of others, fewest edits first, that overlap no chosen one."""
    chosen: list[tuple[int, int, int]] = []
    for start, (edits, end) in sorted(spans.items(), key=lambda span: (span[1][0], span[0])):
        at = bisect(chosen, (start,))
        free = (not at or chosen[at - 1][1] <= start) and (at == len(chosen) or chosen[at][0] >= end)
        if free or not edits:
            chosen.insert(at, (start, end, edits))
    return chosen


def scan_notices(documents: DataFrame, notices: tuple[Notice, ...] = BASE_NOTICES + MORE_NOTICES) -> DataFrame:
    """(doc_id, n_words, spans) for each row of documents (doc_id, text).

    spans holds, in order, the label, first word (from 0), number of words, edits, the notice's length and
    the text found. Exact places are all reported; an inexact one only where no better one of the same
    notice overlaps it. Null, empty and wordless texts have no words and no spans. Repeated rows get
    equal results; other columns are ignored; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            n_words, spans = [], []
            for text in batch["text"]:
                words = words_of(text.as_py())
                n_words.append(len(words))
                spans.append(scanner.spans(f" {b' '.join(words).decode('utf-8', 'surrogatepass')} ") if words else [])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(SPAN))], ["doc_id", "n_words", "spans"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, f"doc_id long, n_words long, spans {SPAN_DDL}")
