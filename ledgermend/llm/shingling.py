"""Words and word shingles of whole Arrow columns as 64-bit hashes, without a Python object per word.

Words are the runs between the bytes 0x09-0x0D and 0x20, with A-Z lower-cased unless said otherwise. All passes are
numpy over the UTF-8 bytes, in windows of bounded size that end between words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 16
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold_case: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    letters = np.arange(256)
    if fold_case:
        letters[65:91] += 32
    return values[letters]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


_VALUES = {fold: _byte_values(fold) for fold in (True, False)}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = {"up": _powers(_BASE, 1 << 12), "down": _powers(_INVERSE, 1 << 12)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > WINDOW:  # one word longer than a window: not kept
        return _powers(_BASE, n), _powers(_INVERSE, n)
    if len(_POWERS["up"]) < n:
        _POWERS["up"], _POWERS["down"] = _powers(_BASE, WINDOW), _powers(_INVERSE, WINDOW)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def parts_of(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts have about `most` bytes, or of one text."""
    for batch in batches:
        for start, end in _ranges(batch[text], most):
            yield batch.slice(start, end - start)
        release()


def release() -> None:
    """Returns freed memory to the system, as workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim:
        trim(0)


def parts_of_column(column: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """The texts of a column in slices of about `most` bytes, or of one text."""
    for start, end in _ranges(column, most):
        yield column.slice(start, end - start)
    release()


def _ranges(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, end
        start = end


def _words_of_window(data: np.ndarray, text_starts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word; text_starts are offsets where a word cannot go on."""
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    before[text_starts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends_before = text_starts[text_starts > 0] - 1
    after[ends_before] = False
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_BASE)), starts


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets of its texts in them (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and each text's offset among them."""
    data, offsets = text_bytes(column)
    hashes, starts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        end = min(at + WINDOW, len(data))
        if end < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:  # a word of more than a window: up to its end
                end += 1
                while end < len(data) and not _SPACE[data[end - 1]]:
                    block = np.flatnonzero(_SPACE[data[end : end + WINDOW]])
                    end = end + int(block[0]) + 1 if len(block) else min(end + WINDOW, len(data))
        low, high = np.searchsorted(offsets, [at, end])
        inner = np.unique(offsets[low:high]) - at
        found, where = _words_of_window(data[at:end], inner, _VALUES[fold_case])
        hashes.append(found)
        starts.append(where + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles of `width` words, sorted.

    A text of fewer words has its whole word sequence as only shingle, one without words none.
    """
    words, offsets = word_hashes(column)
    if len(words) >= width:
        windows = len(words) - width + 1
        shingles = mix(words[:windows] + np.uint64(width))
        for k in range(1, width):
            shingles = mix(shingles + words[k : k + windows])
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        n = int(end - start)
        if n >= width:
            yield np.unique(shingles[start : end - width + 1])
        elif n:
            value = mix(words[start : start + 1] + np.uint64(n))
            for k in range(1, n):
                value = mix(value + words[start + k : start + k + 1])
            yield value
        else:
            yield np.zeros(0, np.uint64)


def shingle_hashes(column: pa.Array, width: int) -> np.ndarray:
    """The hashes of all places of the column's `width`-word shingles, shorter texts left out."""
    words, offsets = word_hashes(column)
    windows = len(words) - width + 1
    if windows <= 0:
        return np.zeros(0, np.uint64)
    shingles = mix(words[:windows] + np.uint64(width))
    for k in range(1, width):
        shingles = mix(shingles + words[k : k + windows])
    inner = offsets[1:-1]
    crossing = (inner[:, None] - np.arange(1, width)[None, :]).ravel()
    keep = np.ones(windows, bool)
    crossing = crossing[(crossing >= 0) & (crossing < windows)]
    keep[crossing] = False
    return shingles[keep]
