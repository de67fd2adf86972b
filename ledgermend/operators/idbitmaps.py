"""Distinct identifiers as bitmaps that merge between periods.

A dictionary numbers all ids; a customer's ids are the bits of bitmaps of 32,768 numbers each. Bitmaps of two periods
are merged by OR, exactly, without going back to the rows. NULL is number 0, which has a bitmap of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermend.operators.idlists import KEY, of_known_customers
from ledgermend.sources.workspace import written

BITS = 32_768
"""Bits of one of Spark's bitmaps."""

_PLACE = (1 << 33) - 1
_BLOCK = 64


def dictionary(ids: DataFrame, column: str, path: str) -> DataFrame:
    """(id, number): the different ids of a column as text, in order, numbered from 1; written at path.

    Numbers are prefix sums over the partitions of a range partitioning, so no task sorts all ids.
    """
    placed = (
        ids.select(F.col(column).cast("string").alias("id")).where("id IS NOT NULL").distinct()
        .repartitionByRange("id").sortWithinPartitions("id")
        .select("id", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("place"))
    )
    placed = written(placed, f"{path}/placed")
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    before = placed.groupBy("piece").count().select("piece", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    numbered = placed.join(F.broadcast(before), "piece").select("id", (F.col("before") + F.col("place") + 1).alias("number"))
    return written(numbered, f"{path}/dictionary")


def bitmaps(rows: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """(customer_id, bucket, bitmap) of the distinct ids in ``column`` per customer; ids that the dictionary lacks are refused."""
    pairs = of_known_customers(rows).select(KEY, F.col(column).cast("string").alias("id")).distinct()
    numbered = pairs.join(words, "id", "left")
    number = F.when(F.col("id").isNull(), F.lit(0).cast("long")).otherwise(
        F.coalesce("number", F.raise_error(F.concat(F.lit("no number for id "), F.col("id"))).cast("long"))
    )
    placed = numbered.select(KEY, number.alias("number"))
    return placed.groupBy(KEY, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def merged(*periods: DataFrame) -> DataFrame:
    """The bitmaps of several periods, made with one dictionary, as those of all of them."""
    rows = periods[0]
    for period in periods[1:]:
        rows = rows.unionByName(period)
    return rows.groupBy(KEY, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def id_counts(maps: DataFrame) -> DataFrame:
    """(customer_id, ids): how many different ids each customer has, NULL not counted, from the bitmaps alone."""
    return maps.groupBy(KEY).agg(F.coalesce(F.sum(F.when(F.col("bucket") > 0, F.bitmap_count("bitmap"))), F.lit(0)).alias("ids"))


def expanded(maps: DataFrame, words: DataFrame) -> DataFrame:
    """(customer_id, id): a row for each bit that is set."""
    # Bitmaps are mostly empty: blocks of them are passed over as a whole.
    blocks = f"filter(sequence(0, (octet_length(bitmap) - 1) div {_BLOCK}), b -> substring(bitmap, b * {_BLOCK} + 1, {_BLOCK}) <> X'{'00' * _BLOCK}')"
    within = f"flatten(transform({blocks}, b -> sequence(b * {_BLOCK} + 1, b * {_BLOCK} + {_BLOCK})))"
    filled = f"filter({within}, i -> substring(bitmap, i, 1) <> X'00')"
    octets = maps.select(KEY, "bucket", "bitmap", F.expr(f"{filled} AS places")).select(
        KEY, "bucket", F.explode_outer(F.expr("transform(places, i -> struct(i AS place, cast(conv(hex(substring(bitmap, i, 1)), 16, 10) AS int) AS octet))")).alias("o")
    )
    bits = F.expr("filter(sequence(0, 7), j -> (shiftright(o.octet, j) & 1) = 1)")
    found = octets.select(KEY, "bucket", "o.place", F.explode_outer(bits).alias("bit"))
    number = F.expr(f"CASE WHEN bucket > 0 THEN (bucket - 1) * {BITS} + (place - 1) * 8 + bit + 1 ELSE 0L END")
    return found.select(KEY, number.alias("number")).join(words, "number", "left").select(KEY, "id")
