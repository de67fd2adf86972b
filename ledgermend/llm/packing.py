"""Order-preserving packing of documents into sequences by dynamic programming.

The ids of all documents, in doc_id order, are one line that is cut into windows of at most `length` ids.
Cuts may lie behind a document, behind a sentence or, where sentences are long, at a fixed step. A plan costs
the padding of its windows plus a penalty for each cut inside a document, higher inside a sentence. The
cheapest plan up to a place extends the cheapest plan up to an earlier one; as padding is linear in the
window's start, the best start of the last `length` ids is the head of a monotone queue, and each
place costs constant time. Windows whose length is a power of two need no padding and are extra transitions.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermend.llm.shingling import parts_of
from ledgermend.llm.store import ship
from ledgermend.llm.word_bpe import word_bpe

SENTENCE_CUT, INNER_CUT = 16, 96
"""Padding ids that a cut behind a sentence, or inside one, is worth."""

STEP = 32
"""Where no sentence ends for longer than this, cuts may lie at every STEP ids."""

RUN = 1 << 19
"""Ids that are planned at once; the last window of a run is planned again with the next one."""

SHORTEST = 256
"""The shortest window that is made to save padding."""


@lru_cache(maxsize=2)
def sentence_ends(vocabulary: str) -> np.ndarray:
    """For each id, whether its token ends a sentence."""
    tokens = word_bpe(vocabulary).tokenizer.get_vocab()
    ends = np.zeros(max(tokens.values()) + 1, bool)
    for token, number in tokens.items():
        mark = token.removesuffix("</w>")
        ends[number] = mark != token and bool(mark) and mark[0] in ".!?" and not any(c.isalnum() for c in mark)
    return ends


def places(ids: np.ndarray, document_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the line may be cut, from 0 to its end, and what each cut costs."""
    sentence, cut = np.zeros(len(ids) + 1, bool), np.zeros(len(ids) + 1, bool)
    sentence[1:] = ends.take(ids, mode="clip")
    cut[[0, -1]] = cut[document_ends] = True
    fixed = np.flatnonzero(cut | sentence)
    steps = (np.diff(fixed) - 1) // STEP  # inside each gap
    number = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps) + 1
    cut[np.repeat(fixed[:-1], steps) + STEP * number] = True
    at = np.flatnonzero(cut | sentence)
    costs = np.where(sentence[at], SENTENCE_CUT, INNER_CUT)
    costs[np.searchsorted(at, document_ends)] = 0
    costs[-1] = 0
    return at, costs


def cheapest_cuts(at: np.ndarray, costs: np.ndarray, length: int) -> np.ndarray:
    """The places of the cheapest plan, first and last included; neighbours lie at most `length` apart."""
    exact: dict[int, list[int]] = {}
    size = SHORTEST
    while size < length:
        before = np.searchsorted(at, at - size)
        for j in np.flatnonzero(at[before] == at - size).tolist():
            exact.setdefault(j, []).append(int(before[j]))
        size *= 2
    where, penalty = at.tolist(), costs.tolist()
    best, came = [0] * len(where), [0] * len(where)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # cost + place, place, number
    for j in range(1, len(where)):
        here = where[j]
        while queue[0][1] < here - length:
            queue.popleft()
        value, _, start = queue[0]
        cost = value + length - here
        for k in exact.get(j, ()):
            if best[k] < cost:
                cost, start = best[k], k
        cost += penalty[j]
        best[j], came[j] = cost, start
        key = cost + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    path = [len(where) - 1]
    while path[-1]:
        path.append(came[path[-1]])
    return at[path[::-1]]


class _Line:
    """The documents of a task whose ids are not yet in a finished window."""

    def __init__(self, length: int, ends: np.ndarray):
        self.length, self.ends = length, ends
        self.documents: list[tuple[int | None, int, np.ndarray]] = []  # doc_id, ids already placed, ids
        self.waiting = self.sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id, 0, ids))
        self.waiting += len(ids)

    def pieces(self, last: bool) -> Iterator[tuple]:
        """(doc_id, start, ids, doc_tokens, sequence, offset) of the planned windows, but the last one if more follows."""
        line = np.concatenate([ids[placed:] for _, placed, ids in self.documents])
        bounds = np.cumsum([0, *(len(ids) - placed for _, placed, ids in self.documents)])
        cuts = cheapest_cuts(*places(line, bounds[1:], self.ends), self.length)
        done = int(cuts[-1] if last else cuts[-2])
        starts = np.unique(np.concatenate([cuts[cuts < done], bounds[bounds < done]]))
        stops = np.append(starts[1:], done)
        owners = np.searchsorted(bounds, starts, "right") - 1
        windows = np.searchsorted(cuts, starts, "right") - 1
        for start, stop, owner, window in zip(starts.tolist(), stops.tolist(), owners.tolist(), windows.tolist(), strict=True):
            doc_id, placed, ids = self.documents[owner]
            yield doc_id, placed + start - int(bounds[owner]), line[start:stop], len(ids), self.sequences + window, start - int(cuts[window])
        self.sequences += int(np.searchsorted(cuts, done))
        rest = int(np.searchsorted(bounds, done, "right")) - 1
        kept = self.documents[rest:]
        if kept:
            doc_id, placed, ids = kept[0]
            kept[0] = (doc_id, placed + done - int(bounds[rest]), ids)
        self.documents, self.waiting = kept, len(line) - done


SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(documents: DataFrame, vocabulary: str, end_id: int, length: int = 2048) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most `length` ids, in doc_id order.

    One row for each piece: doc_id, its start among the document's ids, its length, the document's ids with
    the end id, sequence and offset there, and the ids as uint32 bytes. Every document has its end id,
    so null and empty texts have one piece. Null doc_ids come first; rows with one doc_id are documents of
    their own, in the order of their texts' hashes. Sequences do not span the partitions of the range
    partitioning by doc_id, and their numbers have the partition in the high bits. Other columns are
    ignored; an empty table gives no rows.
    """

    def rows(pieces: Iterator[tuple], base: int) -> Iterator[pa.RecordBatch]:
        out = list(pieces)
        for at in range(0, len(out), 4096):
            doc_ids, starts, ids, tokens, sequences, offsets = zip(*out[at : at + 4096], strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([base + s for s in sequences], pa.int64()),
                    pa.array(offsets, pa.int64()),
                    pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                ],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        line = _Line(length, sentence_ends(vocabulary))
        bpe, end = word_bpe(vocabulary), np.array([end_id], np.uint32)
        for batch in parts_of(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                line.add(doc_id, np.concatenate([bpe.encode(text), end]))
                if line.waiting >= RUN:
                    yield from rows(line.pieces(last=False), base)
        if line.waiting:
            yield from rows(line.pieces(last=True), base)

    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    return texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(plan, SCHEMA)
