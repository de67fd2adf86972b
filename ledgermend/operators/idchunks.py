"""Identifier lists of any length, as numbered chunks of text.

A list in one cell ends at Spark's 2 GB. Here a list is a run of chunks, each a bounded number of elements; its text is the chunks
in order, joined by commas. No task holds more of a list than a chunk: ids are counted, equal ones in runs, cut by a
range partitioning into consecutive pieces, and turned into chunks where they lie. Chunk numbers and offsets are prefix sums
over the chunks' sizes alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermend.functions.idtext import SEPARATOR, element_text, repeated
from ledgermend.operators.idlists import KEY, IdList, counted_ids, listed_once

RUN = 64
"""Copies of an id in one element of a chunk."""

CHUNK_ROWS = 1024
"""Ids, or runs of one, in a chunk: 65,536 elements at most."""

_PLACE = 33  # bits of a row's place within its partition in monotonically_increasing_id


def write_chunks(lists: Sequence[IdList], path: str, chunk_rows: int = CHUNK_ROWS, run: int = RUN) -> None:
    """Writes the lists at path: ``texts`` (customer_id, list, part, chars, text) and ``index`` with chunk and offset of each part.

    Lists are numbered as given; a customer without rows for a list has no chunk of it. Ids are sorted, NULLs last, as in
    ``id_lists``, of which small lists are one chunk. A call that is repeated replaces what it wrote.
    """
    spark = lists[0].source.sparkSession
    copies = F.when(listed_once(lists), F.lit(1).cast("long")).otherwise(F.col("copies"))
    runs = counted_ids(lists).select(KEY, "list", "id", copies.alias("copies")).select(
        "*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {run})")).alias("run")
    )
    order = (KEY, "list", F.col("id").asc_nulls_last(), "run")
    placed = runs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    element = repeated(element_text("id"), F.least(F.lit(run), F.col("copies") - F.col("run") * run))
    # A part is a block of a partition; both grow with the order of the ids.
    part = F.expr(f"shiftleft(shiftright(row, {_PLACE}), {_PLACE}) + (row & {(1 << _PLACE) - 1}) div {chunk_rows}")
    parts = placed.select(KEY, "list", "row", part.alias("part"), element.alias("element")).groupBy(KEY, "list", "part").agg(
        F.expr(f"listagg(element, '{SEPARATOR}') WITHIN GROUP (ORDER BY row)").alias("text")
    )
    parts.select(KEY, "list", "part", F.length("text").cast("long").alias("chars"), "text").write.mode("overwrite").parquet(f"{path}/texts")
    earlier = Window.partitionBy(KEY, "list").orderBy("part")
    sizes = spark.read.parquet(f"{path}/texts").select(KEY, "list", "part", "chars")
    before = F.sum(F.col("chars") + len(SEPARATOR)).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    index = sizes.select(
        KEY, "list", "part", (F.row_number().over(earlier) - 1).cast("long").alias("chunk"), F.coalesce(before, F.lit(0)).cast("long").alias("offset"), "chars"
    )
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(customer_id, list, chunk, offset, chars, text): a list's text is its chunks in order, joined by commas."""
    texts = spark.read.parquet(f"{path}/texts").drop("chars").alias("t")
    index = spark.read.parquet(f"{path}/index").alias("i")
    same = F.expr(f"t.{KEY} <=> i.{KEY} AND t.list = i.list AND t.part = i.part")
    return index.join(texts, same).select(f"i.{KEY}", "i.list", "chunk", "offset", "chars", "text")
