"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.llm.byte_bpe import round_trip
from ledgermend.llm.conversation_repair import damaged, repair, transcript_hashes
from ledgermend.llm.decontamination import contamination
from ledgermend.llm.exact_dedup import DigestIndex, deduplicate
from ledgermend.llm.jaccard_join import jaccard_components
from ledgermend.llm.license_scan import BASE_NOTICES, scan_notices
from ledgermend.llm.packing import pack
from ledgermend.llm.pfor import read_ids, write_ids
from ledgermend.llm.quality_classifier import held_out, quality_score, train
from ledgermend.llm.quality_rules import base_failed, judged, stats_of
from ledgermend.llm.sharding import shard_rows
from ledgermend.llm.sql import ORACLE_SQL
from ledgermend.llm.token_alignment import alignments
from ledgermend.llm.store import new_path, table, written
from ledgermend.llm.warc import read_archives, write_archives

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@_query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_notices(table(spark, sf_dir, "documents"))
    base = ", ".join(f"'{notice.label}'" for notice in BASE_NOTICES)
    joined = "array_join(array_sort(array_distinct({})), ',')"
    exact = f"filter(spans, s -> s.edits = 0 and s.label in ({base}) and s.found in ({', '.join(repr(n.phrase) for n in BASE_NOTICES)}))"
    found = scanned.withColumn("exact", F.expr(exact))
    return found.select(
        "doc_id",
        "n_words",
        F.expr("cast(size(exact) as bigint)").alias("n_base"),
        F.expr("array_min(exact.word)").alias("first_word"),
        F.expr("array_max(exact.word)").alias("last_word"),
        F.expr(joined.format("exact.label")).alias("base_labels"),
        F.expr(joined.format("spans.label")).alias("labels"),
        F.expr("coalesce(array_max(transform(spans, s -> 1 - s.edits / s.length)), 0D)").alias("score"),
    )


@_query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rows = written(documents.select("doc_id", "lang", "source", stats_of(F.col("text")).alias("stats")), "stats")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(rows, "stats", "kept").select(
        "doc_id", *[F.col(f"stats.{name}").alias(name) for name in counts], base_failed("stats").alias("base_failed"), "kept"
    )


@_query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


@_query
def op4_pfor_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = new_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), files, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_ids(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    scored = documents.select("doc_id", quality_score(documents, model).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = table(spark, sf_dir, "documents").select("doc_id", round_trip(F.col("text"), *vocabulary).alias("of"))
    return both.select(
        "doc_id",
        F.size("of.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("of.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("of.bytes", 256).alias("decoded_sha256"),
    )


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, length=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query
def op8_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard_rows(table(spark, sf_dir, "documents"), shards=16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op9_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, new_path(spark, "digest-index"))
    found = deduplicate(table(spark, sf_dir, "documents"), index)
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), archives)
    return read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = repair(damaged(conversations))
    hashes = transcript_hashes(repaired.turns)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = every.alias("e").join(repaired.conversations.alias("r"), F.expr("e.conv_id <=> r.conv_id"), "left").join(hashes.alias("h"), F.expr("e.conv_id <=> h.conv_id"), "left")
    counts = [F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        "e.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return alignments(table(spark, sf_dir, "documents"), *vocabularies, groups=[digest]).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
