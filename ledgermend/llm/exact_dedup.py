"""Exact deduplication against a persistent digest index, with DataFrame functions only.

The index is a table of one row per digest, bucketed and sorted by digest. New data is first reduced
to one row per digest with map-side partial aggregation, so that a text with a third of all rows
sends one row per task; only these rows meet the index, in a sort-merge anti-join for which the index
is read bucket by bucket and not shuffled. What the index lacks is appended to it.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.llm.store import forget, free_name, written

SPACES = " \t\n\x0b\x0c\r"
BUCKETS = 64
"""Buckets of a new index; choose so many that one bucket's rows fit in a task."""

BROADCAST_ROWS = 1 << 20
"""Up to so many rows that go are broadcast by their ids (some 100 bytes each); more are joined by a shuffle."""


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


@dataclass(frozen=True)
class DigestIndex:
    """A digest index at a path: digest, keep_id (the document that stays), keep_chars, and the batch that brought them."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    @property
    def name(self) -> str:
        return "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def open(self) -> DataFrame:
        """The index as a bucketed table; empty at a new path, with the earlier rows at an old one."""
        known = self.spark.catalog.tableExists(self.name)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, keep_chars BIGINT, batch STRING) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if not known:  # batches that lie there already
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(place)
            self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, rows: DataFrame, batch: str) -> None:
        """Adds the rows of a batch, one file per bucket; a batch that is added again replaces itself."""
        view = f"rows_of_{self.name}"
        rows.select("digest", "keep_id", "keep_chars").repartition(self.buckets, "digest").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{batch}') SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Takes the table out of the catalog; its rows stay at the path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _content_name(groups: DataFrame) -> str:
    """A name that a batch has by its rows alone, in any order."""
    mixed = F.xxhash64("digest", "group_size", "best.doc_id", "best.n_chars")
    found = groups.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(mixed), F.lit(0)).alias("x"), F.coalesce(F.sum(F.pmod(mixed, F.lit(1 << 20))), F.lit(0)).alias("s")).first()
    return f"{found.n}_{found.x & (1 << 64) - 1:016x}_{found.s}"


def deduplicate(documents: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_chars) for each row of documents (doc_id, text).

    Texts are equal when identical without white space; null counts as empty, so null, empty and
    blank texts are one group. Of a group that the index does not know, the row with most code
    points stays, then the smallest doc_id (null last), then any one of repeated rows; the index
    learns it. Of a group that the index knows no row stays, and keep_id is the known one. group_size counts
    the rows of this call. Other columns are ignored; an empty table gives no rows.

    What the index learns bears the batch's name, by default one made from the batch's contents, and a batch is compared
    with other batches only. So a call that is repeated, after a failure say, gives equal results and leaves an equal index.
    """
    rows = written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.unhex(digest(F.col("text"))).alias("digest"),
            F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("low"), (-F.col("row")).alias("row"), "doc_id"))
    groups = written(rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")), "groups")
    own = _content_name(groups) if batch is None else re.sub(r"[^A-Za-z0-9_-]", lambda c: f"_{ord(c.group()):x}_", batch)
    others = index.open().where(F.col("batch") != own)
    fresh = groups.hint("merge").join(others, "digest", "left_anti")
    fresh = written(
        fresh.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.n_chars").alias("keep_chars"), (-F.col("best.row")).alias("keep_row")),
        "fresh",
    )
    index.append(fresh, own)
    verdicts = groups.select("digest", "group_size").join(index.open(), "digest").join(fresh.select("digest", "keep_row"), "digest", "left")
    # Written, so that the result needs neither the index nor its table.
    verdicts = written(verdicts.select("digest", "group_size", "keep_id", "keep_row"), "verdicts")
    forget(groups, fresh)
    return rows.join(verdicts, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_chars",
    )


def kept_documents(documents: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The rows of documents that stay, with all their columns: one of each group that the index did not know.

    The decisions are those of `deduplicate`; of repeated rows (one doc_id, equal text and length) one stays. Texts
    are not shuffled while the rows that go are few enough for their ids to be broadcast.
    """
    decided = written(deduplicate(documents, index, batch), "decided")
    key, sha, chars = (free_name(documents, name) for name in ("of_doc_id", "of_text", "of_chars"))
    alike = decided.groupBy("doc_id", "text_sha256", "n_chars").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows"))
    alike = written(alike, "alike")
    gone = alike.where("not kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha + "_"), F.col("n_chars").alias(chars))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key))
    if decided.groupBy("doc_id").count().where("count > 1").isEmpty():  # the id alone names a row
        return documents.join(gone, same, "left_anti")
    rows = documents.withColumn(sha, digest(F.col("text")))
    same = same & (F.col(sha) == F.col(sha + "_")) & (F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)) == F.col(chars))
    stay = rows.join(gone, same, "left_anti")
    if not alike.where("kept and rows > 1").isEmpty():
        stay = stay.dropDuplicates(["doc_id", sha])
    return stay.drop(sha)
