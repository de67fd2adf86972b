"""Word-level BPE with the tokenizers library, piece by piece.

The vocabulary's normaliser folds white space and letters, its pre-tokeniser cuts a text into pieces,
and the merges of a piece depend on nothing else. Pieces repeat far more than texts, so each worker keeps the
ids of the pieces that it has met, and gives the library's model a text's new pieces at once, with spaces between. Runs of words of
plain letters, digits and marks are cut into pieces here; any other word, and any that may hold an added token such as
<|endoftext|>, goes through the whole tokeniser. A word ends at an ASCII space, which no piece holds and which normalisation
leaves alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import tokenizers

KEPT_WORDS, KEPT_PIECES = 1 << 16, 1 << 18
"""Words and pieces in each of the two generations that a worker keeps."""

#: Letters that are their own composed form and have one lower-case letter: Latin-1 without signs.
_LETTER = "a-zß-öø-ÿ"
_PLAIN = rf"\x21-\x7e{_LETTER}À-ÖØ-Þ"
_ALL_PLAIN = re.compile(rf"[ \t\n\r{_PLAIN}]*")
_RUNS = re.compile(rf"((?:[{_PLAIN}]++(?=[ \t\n\r]|\Z)|[ \t\n\r]++)++)|([^ \t\n\r]+)")
"""Plain words with the spaces between them, or one other word."""

_PIECES = re.compile(rf"[{_LETTER}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\s0-9{_LETTER}]+")
_WORDS = re.compile(r"[^ \t\n\r]+")
_CHUNK = 1 << 16


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = "".join(letter for _, letter in sorted(_byte_letters().items()))
_LETTERS = {byte: letter for byte, letter in enumerate(BYTE_LETTERS) if byte != ord(" ")}


class Generations(dict):
    """The results of a function of a string: those asked for lately, in two generations of at most `most`.

    When the young generation is full it becomes the old one, whose entries come back when asked for. So what is
    asked for often stays, and what occurs once goes.
    """

    def __init__(self, compute, most: int):
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) < 100:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class JointGenerations:
    """Like Generations, for a function of many strings at once that costs less than one by one; `most` is exceeded by one call's keys."""

    def __init__(self, compute, most: int):
        self.compute, self.most = compute, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def joined(self, keys: list[str]) -> bytes:
        """The results of all keys, one behind the other."""
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        if None not in found:
            return b"".join(found)
        places = [place for place, value in enumerate(found) if value is None]
        new = []
        for key in dict.fromkeys(keys[place] for place in places):
            if key in old:
                young[key] = old[key]
            else:
                new.append(key)
        if new:
            young.update(zip(new, self.compute(new), strict=True))
        for place in places:
            found[place] = young[keys[place]]
        for key in new:
            if len(key) >= 100:
                del young[key]
        return b"".join(found)


class WordBpe:
    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # the tokens that end a piece
        self.last[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        # The model alone, for pieces as byte letters between spaces.
        self.model = tokenizers.Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        self.words = Generations(self._word, KEPT_WORDS)
        self.pieces = JointGenerations(self._pieces, KEPT_PIECES)

    def _word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _pieces(self, pieces: list[str]) -> Iterable[bytes]:
        text = " ".join(pieces)
        letters = text if text.isascii() else text.encode().decode("latin-1").translate(_LETTERS)
        ids = np.array(self.model.encode(letters, add_special_tokens=False).ids, "<u4")
        data, stops = ids.tobytes(), (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
        return (data[start:stop] for start, stop in zip([0, *stops[:-1]], stops, strict=True))

    def _run(self, plain: str, other: str) -> bytes:
        lower = plain.lower()
        if other or any(token in lower for token in self.added):
            return b"".join(map(self.words.__getitem__, _WORDS.findall(plain or other)))
        return self.pieces.joined(_PIECES.findall(lower))

    def _chunk(self, text: str) -> bytes:
        if _ALL_PLAIN.fullmatch(text):
            return self._run(text, "")
        return b"".join(self._run(*run) for run in _RUNS.findall(text))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text, without special tokens; null counts as empty."""
        text, parts, at = text or "", [], 0
        while len(text) - at > _CHUNK:
            cut = text.find(" ", at + _CHUNK)
            if cut < 0:
                break
            parts.append(self._chunk(text[at:cut]))
            at = cut
        parts.append(self._chunk(text[at:]))
        return np.frombuffer(b"".join(parts), "<u4")


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """The encoder of a vocabulary file, kept by each worker."""
    return WordBpe(path)
