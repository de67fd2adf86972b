"""Quality classifier by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes a row of hashed word frequencies, weighted by inverse document frequency, beside soft
bins of its surface rates (symbols, capitals, repeats and so on). A singular value decomposition of
the labelled rows gives the latent space. The labelled vectors are broadcast; every text is compared
with all of them in blocks of exact cosine products, and its nearest neighbours vote with their labels,
weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.llm.shingling import parts_of, parts_of_column, word_hashes
from ledgermend.llm.text_stats import text_stats

TRAIN_ROWS = 4000
"""Labelled rows that are learned from: those with the smallest hashes of their doc_id."""

TERMS, RANK, NEIGHBOURS, BLOCK = 1024, 48, 25, 256
BINS = 8
SHAPE_WEIGHT = 2.0
"""Weight of the surface rates against the words, whose part has length 1."""


def _soft_bins(x: np.ndarray) -> np.ndarray:
    """Values of 0 to 1 as weights of the two nearest of BINS centres, of length 1."""
    at = np.clip(x, 0, 1) * (BINS - 1)
    weights = np.maximum(0, 1 - np.abs(at[..., None] - np.arange(BINS)))
    return (weights / np.linalg.norm(weights, axis=-1, keepdims=True)).reshape(len(x), -1)


def surface(column: pa.Array) -> np.ndarray:
    """Soft bins of each text's surface rates."""
    s = {name: values.astype(float) for name, values in text_stats(column).items()}
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    rates = [
        np.sqrt(np.minimum(1, 2 * s["n_symbols"] / chars)),
        np.sqrt(s["n_upper"] / chars),
        np.sqrt(np.minimum(1, 4 * s["n_marks"] / chars)),
        np.sqrt(s["n_repeat_words"] / words),
        np.sqrt(s["n_dup_lines"] / np.maximum(s["n_lines"], 1)),
        np.sqrt(s["n_twice"] / words),
        s["n_different"] / words,
        np.minimum(1, s["word_chars"] / words / 12),
        np.log1p(s["n_words"]) / 12,
    ]
    return _soft_bins(np.stack(rates, axis=1)) / np.sqrt(len(rates))


def word_counts(column: pa.Array) -> np.ndarray:
    """Dampened frequencies of hashed words, a dense row for each text."""
    words, at = word_hashes(column)
    rows = np.repeat(np.arange(len(column)), np.diff(at))
    places = rows * TERMS + (words % np.uint64(TERMS)).astype(np.int64)
    return np.log1p(np.bincount(places, minlength=len(column) * TERMS)).reshape(len(column), TERMS).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class NeighbourModel:
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @staticmethod
    def features(counts: np.ndarray, idf: np.ndarray, shape: np.ndarray) -> np.ndarray:
        return np.hstack([_unit(counts * idf), SHAPE_WEIGHT * shape]).astype(np.float32)

    @classmethod
    def fit(cls, counts: np.ndarray, shape: np.ndarray, labels: np.ndarray) -> NeighbourModel:
        idf = np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1
        rows = cls.features(counts, idf, shape).astype(np.float64)
        values, axes = np.linalg.eigh(rows.T @ rows)
        space = axes[:, np.argsort(values)[::-1][:RANK]].astype(np.float32)
        return cls(idf.astype(np.float32), space, _unit(rows.astype(np.float32) @ space), labels.astype(np.float32))

    def scores(self, column: pa.Array) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest labelled vectors."""
        out = []
        for block in (part.slice(at, BLOCK) for part in parts_of_column(column) for at in range(0, len(part), BLOCK)):
            block = self.features(word_counts(block), self.idf, surface(block))
            cosines = _unit(block @ self.space) @ self.vectors.T
            k = min(NEIGHBOURS, cosines.shape[1])
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 1e-6).astype(np.float64) ** 8
            out.append((weights * self.labels[nearest]).sum(axis=1) / weights.sum(axis=1))
        # The last digits depend on how texts fall into blocks.
        return np.round(np.concatenate(out), 6) if out else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality") -> NeighbourModel:
    """Learns from at most TRAIN_ROWS labelled documents that are not held out.

    Labels other than 0 and 1, and rows without doc_id or label, are not used; of repeated rows one
    counts. Without any usable label, every score is 1: nothing is known against a document.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            counts, shape = word_counts(batch["text"]), surface(batch["text"]).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array([c.tobytes() for c in counts], pa.binary()), pa.array([s.tobytes() for s in shape], pa.binary())],
                ["doc_id", "label", "counts", "shape"],
            )

    # TRAIN_ROWS ids bound the broadcast side, and as many rows of fixed length come to the driver.
    learned = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(rows, "doc_id long, label int, counts binary, shape binary").toArrow()
    learned = learned.group_by("doc_id").aggregate([("label", "min"), ("counts", "min"), ("shape", "min")]).sort_by("doc_id")
    if not learned.num_rows:
        return NeighbourModel(np.ones(TERMS, np.float32), np.zeros((TERMS + 9 * BINS, 1), np.float32), np.zeros((1, 1), np.float32), np.ones(1, np.float32))
    table = lambda name: np.frombuffer(b"".join(learned[name].to_pylist()), np.float32).reshape(learned.num_rows, -1)
    return NeighbourModel.fit(table("counts_min"), table("shape_min"), learned["label_min"].to_numpy())


def quality_score(documents: DataFrame, model: NeighbourModel, text: str = "text") -> Column:
    """A column with each whole text's score of 0 to 1.

    Null counts as empty, which is scored like any text. Equal texts have equal scores; of labelled vectors that are equally near at
    the edge of the neighbourhood any may vote. Texts of any length are read whole; other columns play no part.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts), pa.float64())

    return score(F.coalesce(F.col(text).cast("string"), F.lit("")))
