"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents in blocks of BLOCK ids (the last one shorter). A block stores
its minimum, and each id's distance from it in as many bits as most of them need; the distances beyond, the
exceptions, stand in a list of places and values behind the packed bits. The foot of the file has the start
of every block and the number of ids of every document, so that a reader can go to any document.

    magic, blocks, document ids (int64), their validity (uint8), ids of each (uint64), block starts (uint64),
    trailer: documents, blocks, ids, start of the foot (uint64 each), magic

All numbers are little-endian.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.llm.files import committed, filesystem, read_manifest, write_manifest
from ledgermend.llm.shingling import parts_of
from ledgermend.llm.word_bpe import word_bpe

MAGIC = b"PFORIDS1"
BLOCK = 4096
IN_WIDTH = 90
"""Percent of a block's ids that its width must hold; the others are exceptions."""

_HEAD = struct.Struct("<IHBxHxx")
_TRAILER = struct.Struct("<QQQQ8s")


def pack_block(ids: np.ndarray) -> bytes:
    """One block of 1 to BLOCK ids."""
    low = int(ids.min())
    distances = (ids - np.uint32(low)).astype("<u4")
    rank = -(-len(ids) * IN_WIDTH // 100) - 1
    width = int(np.partition(distances, rank)[rank]).bit_length()
    beyond = np.flatnonzero(distances >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    patches = beyond.astype("<u2").tobytes() + distances[beyond].tobytes()
    distances[beyond] = 0
    bits = np.unpackbits(distances.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little") if width else np.zeros(0, np.uint8)
    return _HEAD.pack(low, len(ids), width, len(beyond)) + np.packbits(bits, bitorder="little").tobytes() + patches


def unpack_block(data: bytes) -> np.ndarray:
    low, n, width, exceptions = _HEAD.unpack_from(data)
    packed = -(-n * width // 8)
    distances = np.zeros((n, 32), np.uint8)
    bits = np.frombuffer(data, np.uint8, packed, _HEAD.size)
    distances[:, :width] = np.unpackbits(bits, count=n * width, bitorder="little").reshape(n, width)
    ids = np.packbits(distances, axis=1, bitorder="little").view("<u4").ravel()
    at = _HEAD.size + packed
    places = np.frombuffer(data, "<u2", exceptions, at)
    ids[places] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return ids + np.uint32(low)


class Writer:
    """Writes documents' ids to a stream, block by block."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.documents: list[int | None] = []
        self.counts: list[int] = []
        self.starts: list[int] = []
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append(doc_id)
        self.counts.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 16 * BLOCK:
            self._blocks(self.n_waiting - self.n_waiting % BLOCK)

    def _blocks(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, n, BLOCK):
            self.starts.append(self.at)
            self._write(pack_block(ids[at : min(at + BLOCK, n)]))
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._blocks(self.n_waiting)
        foot = self.at
        valid = np.array([d is not None for d in self.documents], np.uint8)
        self._write(np.array([d or 0 for d in self.documents], "<i8").tobytes() + valid.tobytes())
        self._write(np.array(self.counts, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self._write(_TRAILER.pack(len(self.documents), len(self.starts), self.n_ids, foot, MAGIC))


class Reader:
    """Reads a file that Writer wrote; `source` is seekable."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        documents, blocks, self.n_ids, foot, magic = _TRAILER.unpack(self._at(size - _TRAILER.size, _TRAILER.size))
        if magic != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token ids")
        data = self._at(foot, size - _TRAILER.size - foot)
        valid = np.frombuffer(data, np.uint8, documents, 8 * documents)
        self.documents = [int(d) if v else None for d, v in zip(np.frombuffer(data, "<i8", documents), valid, strict=True)]
        self.counts = np.frombuffer(data, "<u8", documents, 9 * documents).astype(np.int64)
        self.bounds = [*np.frombuffer(data, "<u8", blocks, 17 * documents).tolist(), foot]

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from one place of the file to another, from the blocks that hold them."""
        first, last = start // BLOCK, -(-end // BLOCK)
        if start >= end:
            return np.zeros(0, "<u4")
        data = self._at(self.bounds[first], self.bounds[last] - self.bounds[first])
        parts = [unpack_block(data[self.bounds[b] - self.bounds[first] : self.bounds[b + 1] - self.bounds[first]]) for b in range(first, last)]
        return np.concatenate(parts)[start - first * BLOCK : end - first * BLOCK]


MANIFEST_SCHEMA = "file string, number long, documents long, ids long, start long"


def write_ids(documents: DataFrame, uri: str, vocabulary: str, end_id: int) -> None:
    """Writes each whole text's ids and end_id to files at uri, in ascending doc_id order.

    documents has doc_id and text; null texts count as empty and have the end id only. Null doc_ids come
    first, repeated ones in the order of their texts' hashes. Each partition of a range partitioning by
    doc_id becomes one file, written as a stream; an empty table gives a manifest without files. Other
    columns are ignored.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        name = f"ids-{number:06d}.pfor"
        batches = parts_of(batches)
        first = next(batches, None)
        if first is None:
            return
        bpe, end = word_bpe(vocabulary), np.array([end_id], np.uint32)
        with committed(f"{uri}/{name}") as out:
            writer = Writer(out)
            batch = first
            while batch is not None:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    writer.add(doc_id, np.concatenate([bpe.encode(text), end]))
                batch = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "number": [number], "documents": [len(writer.documents)], "ids": [writer.n_ids]})

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    # One row for each file comes to the driver, which adds up where each file starts.
    written = ordered.mapInArrow(write, "file string, number long, documents long, ids long").collect()
    files, start = [], 0
    for row in sorted(written, key=lambda r: r.number):
        files.append({**row.asDict(), "start": start})
        start += row.ids
    write_manifest(uri, files)


def read_ids(spark: SparkSession, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document's place among all ids, and its ids as uint32 bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                system, path = filesystem(f"{uri}/{file}")
                with system.open_input_file(path) as source:
                    yield from _documents(Reader(source), base)

    files = read_manifest(spark, uri, MANIFEST_SCHEMA)
    return files.select("file", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _documents(reader: Reader, base: int, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The documents of a file, in batches of about `most` ids or of one document."""
    ends = np.cumsum(reader.counts)
    at = 0
    while at < len(ends):
        start = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, start + most, "right")))
        ids = reader.ids(start, int(ends[to - 1]))
        cuts = [0, *(ends[at:to] - start).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(reader.documents[at:to], pa.int64()),
                pa.array([base + start + c for c in cuts[:-1]], pa.int64()),
                pa.array(reader.counts[at:to]),
                pa.array([ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            ],
            ["doc_id", "start", "n_tokens", "ids"],
        )
        at = to
