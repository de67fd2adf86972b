"""Alignment of two tokenisers over the same text, and how often their tokens are linked in the whole corpus.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model that puts a space before a text, so A is given space and
text. Tokens of whole characters end with their characters. Where tokens hold parts of a character (one that A cut into
several tokens, B's byte-fallback pieces), the spans that both libraries report, characters from A and bytes from B's proto, are coarse cuts:
tokens that share a character have one end in common, and their own ends are refined from their decoded bytes. Every text's bytes
are checked against those of its tokens. Byte offsets where tokens of both end cut them into groups; tokens whose byte ranges overlap are linked.

Neither tokeniser joins a character with a space after it (which is read off B's vocabulary; otherwise texts stay whole),
so a text is aligned word by word, and each worker remembers the words that it has met.

Links are counted over the corpus in blocks: a block of texts has a list of its different pairs of ids, commonest first, and
each text its links as places in that list. Only the lists are shuffled by pair; the counts come back to the block
that needs them, so no table that grows with the corpus is sent to every task.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermend.llm.shingling import parts_of
from ledgermend.llm.store import written
from ledgermend.llm.word_bpe import BYTE_LETTERS

SPACE = "▁"
KEPT_WORDS = 1 << 17
"""Words that fill a generation; a worker remembers two."""

_BATCH = 1 << 12

BLOCK_BYTES = 1 << 22
"""Bytes of text in a block, about, or one text."""

#: A word with the white space before it; it ends where a space follows. White space at the end of a text belongs to its last word.
_WORDS = re.compile(r"\s*\S+(?:[^\S ]\s*\S*)*(?:\s+\Z)?|\s+")
_FALLBACK = re.compile(r"<0x([0-9A-F]{2})>")
_ID = (1 << 32) - 1


class Aligned(NamedTuple):
    """The alignment of a text or word: counts, groups as text, and links as little-endian 64-bit pairs (id of A << 32 | id of B)."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    links: bytes


NONE = Aligned(0, 0, 0, 0, "", b"")


def exact_ends(begin: int, span_ends: Iterable[int], sizes: Iterable[int]) -> list[int]:
    """The byte where each token of a word ends; span_ends are the ends of the tokens' characters in bytes, sizes their decoded bytes.

    A span's end is a coarse cut: a token that reaches it ends there. One that does not shares its last character with the next
    token, as a part of it or as a byte-fallback piece, and its end is refined from its decoded bytes.
    """
    ends, at = [], 0
    for coarse, size in zip(span_ends, sizes, strict=True):
        at = coarse if at + size == coarse else at + size
        ends.append(begin + at)
    return ends


def _whole(token: bytes) -> bool:
    """Whether a token's bytes are whole characters."""
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {letter: byte for byte, letter in enumerate(BYTE_LETTERS)}
        with open(path_a, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes_a[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            byte = _FALLBACK.fullmatch(piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())
        self.parts_a, self.parts_b = (np.array([not _whole(token) for token in table], int) for table in (self.bytes_a, self.bytes_b))
        # Where no entry goes on after a space that ends a word, words can be encoded one by one.
        self.by_word = not any(" " in entry.lstrip(b" ").decode("utf-8", "replace") for entry in self.bytes_b)
        self.sizes_a, self.sizes_b = np.array(list(map(len, self.bytes_a))), np.array(list(map(len, self.bytes_b)))
        self.names = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))
        self.name_sizes = np.array(list(map(len, self.names)))
        self.young: dict[str, Aligned | None] = {}
        self.old: dict[str, Aligned | None] = {}

    def aligned_words(self, words: list[str]) -> list[Aligned | None]:
        """The alignment of each text that begins with a space; None where tokens' bytes are not the text's."""
        encoded = self.a.encode_batch(words, add_special_tokens=False)
        ids_a, ids_b = [e.ids for e in encoded], self.b.encode([word[1:] for word in words], num_threads=1)
        good = [True] * len(words)
        joined = "".join(words).encode()
        if any(self._bytes(table, chain.from_iterable(ids)) != joined for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
            good = [self._bytes(self.bytes_a, a) == word.encode() == self._bytes(self.bytes_b, b) for word, a, b in zip(words, ids_a, ids_b, strict=True)]
            words, ids_a, ids_b, encoded = ([x for x, ok in zip(column, good, strict=True) if ok] for column in (words, ids_a, ids_b, encoded))
        found = iter(self._aligned(words, ids_a, ids_b, encoded)) if words else iter(())
        return [next(found) if ok else None for ok in good]

    @staticmethod
    def _bytes(table: list[bytes], ids: Iterable[int]) -> bytes:
        return b"".join(map(table.__getitem__, ids))

    def _ends(self, words: list[str], encoded: list, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte where each token of A and B ends, in the joined bytes of the words.

        A token of whole characters ends with its characters. Words with tokens that hold parts of a character are cut by
        the tokenisers' spans, characters from A and bytes from B, and refined where tokens share a character.
        """
        sizes_a, sizes_b = self.sizes_a[a], self.sizes_b[b]
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        of_a, of_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
        begins = np.concatenate([[0], ends_a])[of_a[:-1]].tolist()
        odd_a = np.flatnonzero(np.add.reduceat(self.parts_a[a], of_a[:-1])).tolist()
        odd_b = np.flatnonzero(np.add.reduceat(self.parts_b[b], of_b[:-1])).tolist()
        for k in odd_a:
            byte_of, own = [0, *accumulate(map(len, map(str.encode, words[k])))], slice(of_a[k], of_a[k + 1])
            ends_a[own] = exact_ends(begins[k], (byte_of[end] for _, end in encoded[k].offsets), sizes_a[own].tolist())
        for k, proto in zip(odd_b, self.b.encode([words[k][1:] for k in odd_b], return_type="proto", num_threads=1), strict=True):
            own = slice(of_b[k], of_b[k + 1])  # B's spans begin behind the space that it adds
            ends_b[own] = exact_ends(begins[k], (piece.end + 1 for piece in proto.pieces), sizes_b[own].tolist())
        return ends_a, ends_b

    def _aligned(self, words: list[str], ids_a: list, ids_b: list, encoded: list) -> Iterator[Aligned]:
        """The alignment of texts whose tokens give them back, all in one pass over their joined bytes."""
        n_a, n_b = np.array(list(map(len, ids_a))), np.array(list(map(len, ids_b)))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b = self._ends(words, encoded, a, n_a, b, n_b)

        # Between two neighbouring ends lies one token of each: a link.
        every = np.union1d(ends_a, ends_b)
        links = (a[np.searchsorted(ends_a, every)] << 32 | b[np.searchsorted(ends_b, every)]).astype("<i8").tobytes()
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        limits = ends_a[np.cumsum(n_a) - 1]
        n_links, n_groups = (np.diff(np.searchsorted(cuts, limits, "right"), prepend=0) for cuts in (every, both))

        # All ids in the order of the groups' text, each with the sign that follows it.
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        sign = np.concatenate([last_a.astype(int), 2 * last_b])[order].tolist()
        number = np.concatenate([a, b])[order]
        text = "".join(map(str.__add__, map(self.names.__getitem__, number.tolist()), map(",|;".__getitem__, sign)))
        sizes = np.cumsum(np.concatenate([[0], self.name_sizes[number] + 1]))
        till = sizes[np.cumsum(n_a + n_b)].tolist()
        at = of_link = 0
        for counts in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), till, strict=True):
            to, to_link = counts[4], of_link + 8 * counts[3]
            yield Aligned(*counts[:4], text[at : to - 1], links[of_link:to_link])
            at, of_link = to, to_link

    def _known(self, words: Iterable[str]) -> dict[str, Aligned | None]:
        """The alignment of each different word; those met lately are remembered, in two generations."""
        found: dict[str, Aligned | None] = dict.fromkeys(words)
        new = []
        for word in found:
            if word in self.young:
                found[word] = self.young[word]
            elif word in self.old:
                found[word] = self.young[word] = self.old[word]
            else:
                new.append(word)
        for at in range(0, len(new), _BATCH):
            batch = new[at : at + _BATCH]
            for word, result in zip(batch, self.aligned_words(batch), strict=True):
                found[word] = result
                if len(word) < 100:
                    self.young[word] = result
        if len(self.young) >= KEPT_WORDS:
            self.young, self.old = {}, self.young
        return found

    def align(self, texts: Iterable[str | None]) -> list[Aligned]:
        """The alignment of whole texts; null, empty and texts that a tokeniser does not give back have none."""
        cut = [[] if not text or SPACE in text else _WORDS.findall(" " + text) if self.by_word else [" " + text] for text in texts]
        known = self._known(chain.from_iterable(cut))
        return [_joined([known[word] for word in words]) for words in cut]


def _joined(words: list[Aligned | None]) -> Aligned:
    if not words or None in words:
        return NONE
    if len(words) == 1:
        return words[0]
    n_a, n_b, n_groups, n_links, groups, links = zip(*words, strict=True)
    return Aligned(sum(n_a), sum(n_b), sum(n_groups), sum(n_links), ";".join(groups), b"".join(links))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of two vocabulary files, kept by each worker."""
    return Aligner(path_a, path_b)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), *[(name, pa.int64()) for name in _COUNTS], ("groups", pa.string()), ("links", pa.binary())]
    + [("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))


def _block(block: int, doc_ids: pa.Array, found: list[Aligned]) -> Iterator[pa.RecordBatch]:
    """The rows of a block's texts, whose links are places in its list of pairs, and one row with that list."""
    links = np.frombuffer(b"".join(row.links for row in found), "<i8")
    pairs, places, times = np.unique(links, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")  # small numbers for common pairs
    rank = np.empty(len(pairs), "<i4")
    rank[order] = np.arange(len(pairs))
    cuts = np.cumsum([row.n_links for row in found])
    by_text = [part.tobytes() for part in np.split(rank[places], cuts)[:-1]]
    n = len(found)
    columns = [pa.array([block] * n, pa.int64()), doc_ids.cast(pa.int64()), *[pa.array([getattr(row, name) for row in found], pa.int64()) for name in _COUNTS]]
    columns += [pa.array([row.groups for row in found], pa.string()), pa.array(by_text, pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)
    nothing = [pa.nulls(1, field.type) for field in list(_ALIGNED)[1:-2]]
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *nothing, _list(pairs[order]), _list(times[order])], schema=_ALIGNED)


def aligned(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each row of documents (doc_id, text), and one for each block of them.

    Texts: block, doc_id, n_a, n_b, n_groups, n_links, groups ("a1,a2|b1;a3|b2,b3", ids in order) and links (places in the block's
    pairs, as little-endian 32-bit numbers); pairs is null. Blocks: pairs (id of A << 32 | id of B) and times, how often each is linked.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks are numbered within partitions; a repeated task numbers them alike.
        number, align = TaskContext.get().partitionId() << 32, aligner(path_a, path_b).align
        for batch in parts_of(batches, most=BLOCK_BYTES):
            gc.disable()  # millions of small objects, none of them in a cycle
            try:
                yield from _block(number, batch["doc_id"], align(batch["text"].to_pylist()))
            finally:
                gc.enable()
            number += 1

    kinds = {"block": "long", "doc_id": "long", **dict.fromkeys(_COUNTS, "long"), "groups": "string", "links": "binary", "pairs": "array<long>", "times": "array<long>"}
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, count, best): links of each pair of ids in all blocks, and whether none of its B id has more."""
    each = found.where("pairs IS NOT NULL").select(F.explode_outer(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = written(each.where("pairs IS NOT NULL").groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit(_ID))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # at most B's vocabulary
    return counts.join(F.broadcast(most), b == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of the texts in found, by the pairs' counts."""
    others = [name for name in found.columns if name not in ("block", "links", "pairs", "times")]
    listed = found.where("pairs IS NOT NULL").select("block", F.posexplode_outer("pairs").alias("place", "pair"))
    entries = listed.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("e"))
    lists = entries.select("block", F.transform("e", lambda x: x["place"]).alias("places"), F.transform("e", lambda x: F.when(x["best"], x["count"]).otherwise(-x["count"])).alias("counts"))
    texts = found.where("pairs IS NULL").select("block", F.lit(1).alias("kind"), F.expr("cast(null as array<int>)").alias("places"), F.expr("cast(null as array<long>)").alias("counts"), "links", *others)
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in found.select("links", *others).dtypes]
    heads = lists.select("block", F.lit(0).alias("kind"), "places", "counts", *empty)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_block, signed = None, np.zeros(0, np.int64)
        for batch in batches:
            best, total, keep = [], [], []
            for i, (block, kind) in enumerate(zip(batch["block"].to_pylist(), batch["kind"].to_pylist(), strict=True)):
                if kind == 0:
                    of_block, places = block, batch["places"][i].values.to_numpy()
                    signed = np.zeros(len(places), np.int64)
                    signed[places] = batch["counts"][i].values.to_numpy()
                    continue
                links = np.frombuffer(batch["links"][i].as_buffer(), "<i4")
                values = signed[links] if len(links) and block == of_block else np.zeros(0, np.int64)
                if len(values) != len(links):
                    raise ValueError(f"block {block} has links, but no list of pairs")
                best.append(int(np.count_nonzero(values > 0)))
                total.append(int(np.abs(values).sum()))
                keep.append(i)
            kept = batch.select(others).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(best, pa.int64()), pa.array(total, pa.int64())], [*others, "n_best", "count_sum"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in found.select(*others).dtypes)
    stacked = heads.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind")
    return stacked.mapInArrow(rows, f"{kinds}, n_best long, count_sum long")


def alignments(documents: DataFrame, path_a: str, path_b: str, groups: Iterable = ("groups",)) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) for each row of documents (doc_id, text).

    n_best are the links whose pair has the highest count in the corpus of its B id, ties included; count_sum adds the counts of
    all links. Texts that are null, empty, or not given back byte by byte by a tokeniser (one with U+2581 in it, say)
    have no tokens: zeros and no groups. Repeated rows count each and get a row each; extra columns are ignored; an empty table gives
    no rows. `groups` are the columns to keep in place of groups, which are derived before the texts' rows are written.
    """
    found = aligned(documents, path_a, path_b).select("block", "doc_id", *_COUNTS, *groups, "links", "pairs", "times")
    found = written(found, "aligned")
    return scored(found, written(pair_counts(found), "counts"))
