"""The corpus pipeline: stages that each read what the one before has kept.

A stage takes (spark, docs, sf_dir) and returns rows with the columns of docs; the last one returns the
pieces of packed sequences. Extra columns of docs, whatever their names, are carried along unchanged; an empty
table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.llm.exact_dedup import BROADCAST_ROWS, DigestIndex, kept_documents
from ledgermend.llm.jaccard_join import jaccard_components
from ledgermend.llm.packing import pack
from ledgermend.llm.quality_classifier import quality_score, train
from ledgermend.llm.quality_rules import judged, stats_of
from ledgermend.llm.store import free_name, new_path, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score by their labelled neighbours is 0.3 or more.

    Null and empty texts are scored like others. Repeated rows and equal texts have equal scores and stay or go together.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_score(docs, model) >= 0.3)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie within their group's limits.

    Null, empty and short texts fail the base rule. A null lang or source is a group of its own. Repeated rows and equal
    texts of a group stay or go together, and count once in its limits.
    """
    stats, kept = free_name(docs, "stats"), free_name(docs, "kept")
    # Written, so that texts are counted once, for the limits and for the verdicts.
    rows = judged(written(docs.withColumn(stats, stats_of(F.col("text"))), "counted"), stats, kept)
    return rows.where(F.col(kept)).drop(stats, kept)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, by a digest index that starts empty.

    Null, empty and blank texts are one group. The longest text of a group stays, then the smallest doc_id (null last),
    and of repeated rows one.
    """
    index = DigestIndex(spark, new_path(spark, "digest-index"))
    stay = kept_documents(docs, index)
    index.close()
    return stay


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    Texts without words, null ones too, are alone and stay. Rows of one doc_id are documents of their own: of alike ones one
    stays, unlike ones all do. Rows without doc_id stay, as no group names them.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    key = free_name(docs, "of_row")
    if docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    else:
        # Numbered in order of doc_id, so that the smallest number of a group has its smallest doc_id.
        order = [F.col("doc_id").cast("long"), F.xxhash64("text")]
        rows = written(named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(key, F.monotonically_increasing_id()), "numbered")
    groups = written(jaccard_components(rows.select(F.col(key).alias("doc_id"), "text"), width=5, percent=80), "groups")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    stay = rows.join(gone, key, "left_anti").select(*docs.columns)
    nameless = docs.where(F.col("doc_id").isNull())
    return stay if nameless.isEmpty() else stay.union(nameless)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids.

    Null and empty texts have one piece, which holds the end id alone. Repeated rows are documents of their own, in the order of
    their texts' hashes; rows without doc_id come first.
    """
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, length=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
