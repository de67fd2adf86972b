"""Counts per text over whole Arrow columns; words are runs between the bytes 0x09-0x0D and 0x20."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgermend.llm.shingling import mix, text_bytes, word_hashes

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_twice", "n_different")

_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[0x80:0xC0] = 2  # goes on with a character
_KIND[list(SYMBOLS)] = 3
_KIND[65:91] = 4
_KIND[list(b"!?\"'()[]{}/\\=+~^`_@;:-")] = 5
_LINE_SPACE = " \t\x0b\x0c\r"


def _per_text(kinds: np.ndarray, offsets: np.ndarray, kind: int) -> np.ndarray:
    """How many bytes of a kind each text has."""
    places = np.flatnonzero(kinds == kind)
    return np.diff(np.searchsorted(places, offsets))


def _repeats(words: np.ndarray) -> tuple[int, int]:
    """Words in windows of three that occur twice or more, and different words."""
    different = len(np.unique(words))
    if len(words) < 4:
        return 0, different
    windows = mix(mix(mix(words[:-2]) + words[1:-1]) + words[2:])
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= twice
    return int(covered.sum()), different


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(_LINE_SPACE)]
    return len(lines), len(lines) - len(set(lines))


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts named in STATS for each text; null counts as empty."""
    data, offsets = text_bytes(column)
    kinds = _KIND[data]
    space, more = _per_text(kinds, offsets, 1), _per_text(kinds, offsets, 2)
    words, at = word_hashes(column, fold_case=False)
    repeats = [_repeats(words[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    twice = np.flatnonzero(words[1:] == words[:-1]) + 1
    twice = twice[~np.isin(twice, at)]
    lines = [_lines(text or "") for text in column.to_pylist()]
    columns = {
        "n_words": np.diff(at),
        "word_chars": np.diff(offsets) - space - more,
        "n_symbols": _per_text(kinds, offsets, 3),
        "n_lines": [n for n, _ in lines],
        "n_dup_lines": [d for _, d in lines],
        "n_repeat_words": [r for r, _ in repeats],
        "n_upper": _per_text(kinds, offsets, 4),
        "n_marks": _per_text(kinds, offsets, 5),
        "n_twice": np.diff(np.searchsorted(twice, at)),
        "n_different": [d for _, d in repeats],
    }
    return {name: np.asarray(columns[name], np.int64) for name in STATS}
