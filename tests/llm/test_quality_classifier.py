from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgermend.llm.queries import QUERIES
from ledgermend.llm.quality_classifier import BLOCK, NEIGHBOURS, NeighbourModel, held_out, quality_score, surface, train, word_counts
from ledgermend.llm.store import table


@pytest.fixture(scope="module")
def scored(spark, data_root):
    return QUERIES["op5_quality_classifier"](spark, str(data_root / "sf0.1")).collect()


def test_held_out_accuracy(spark, data_root, scored):
    labels = {r.doc_id: r.quality for r in table(spark, str(data_root / "sf0.1"), "labels").collect()}
    assert len(scored) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    judged = [(r.score, r.predicted, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    assert all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in judged)
    assert np.mean([p == y for _, p, y in judged]) > 0.98
    assert sum(p == 0 for _, p, y in judged if y == 1) <= 0.005 * len(judged)


def test_held_out_labels_do_not_matter(spark, data_root):
    where = str(data_root / "sf0.001")
    docs, labels = table(spark, where, "documents"), table(spark, where, "labels")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = train(docs, labels), train(docs, turned)
    assert np.array_equal(first.vectors, second.vectors) and np.array_equal(first.labels, second.labels)


def test_votes_are_those_of_all_cosines():
    texts = pa.array([f"{'good calm words' if k % 3 else '### $$$ %%%'} number {k} of them {k * 7}" for k in range(2 * BLOCK + 7)])
    labels = np.array([1 if k % 3 else 0 for k in range(len(texts))])
    model = NeighbourModel.fit(word_counts(texts[:100]), surface(texts[:100]), labels[:100])
    got = model.scores(texts)
    rows = model.features(word_counts(texts), model.idf, surface(texts)) @ model.space
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    for k in range(0, len(texts), 50):
        cosines = rows[k] @ model.vectors.T
        nearest = np.argsort(-cosines)[:NEIGHBOURS]
        weights = np.maximum(cosines[nearest], 1e-6).astype(float) ** 8
        assert got[k] == pytest.approx((weights * model.labels[nearest]).sum() / weights.sum(), abs=0.05)
    assert ((got >= 0.3) == (labels == 1)).mean() > 0.98


def test_odd_rows(spark, odd, odd_rows):
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)] + [(None, 1), (3, None), (4, 7), (5, 0), (5, 1)], "doc_id long, quality int")
    model = train(odd, labels)
    got = odd.withColumn("s", quality_score(odd, model)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.s <= 1 for r in got)
    same = {r.s for r in got if r.text == odd_rows[0][1]}
    assert len(same) == 1


def test_no_rows_and_no_labels(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    model = train(odd, empty)
    assert {r.s for r in odd.select(quality_score(odd, model).alias("s")).collect()} == {1.0}
    assert none.select(quality_score(none, model).alias("s")).collect() == []
    assert train(none, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).scores(pa.array(["a"])).tolist() == [1.0]
