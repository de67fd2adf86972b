"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

Rows lie in a fixed number of blocks by a hash. How many rows each block gives to each shard is drawn
exactly: of a block's rows, the counts per shard follow the multivariate hypergeometric law over
what room the shards still have, which is the law of a uniform permutation. Each block then permutes
its rows and deals them out by its counts, and each shard permutes what it has received. The result is a
uniform shuffle with exact sizes, for which no task needs a whole block or shard: the order inside comes
from hashes, hash ranges cut a block or shard into pieces of bounded size, and a piece's first
place is a sum of earlier counts.

Rows are handled by DataFrame functions only. The driver draws the matrix of BLOCKS x shards numbers.
"""

from __future__ import annotations

import math
from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermend.llm.store import written

BLOCKS = 64
PIECE_ROWS = 100_000


def hypergeometric(random: Random, good: int, bad: int, draws: int) -> int:
    """How many of `draws` from good + bad are good: inversion outward from the mode."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    chosen = math.lgamma(good + 1) - math.lgamma(mode + 1) - math.lgamma(good - mode + 1)
    others = math.lgamma(bad + 1) - math.lgamma(draws - mode + 1) - math.lgamma(bad - draws + mode + 1)
    total = math.lgamma(good + bad + 1) - math.lgamma(draws + 1) - math.lgamma(good + bad - draws + 1)
    left = right = math.exp(chosen + others - total)
    chance = random.random() - left
    down = up = mode
    while chance > 0 and (down > low or up < high):
        if up < high:
            right *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            chance -= right
            if chance <= 0:
                return up
        if down > low:
            left *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            chance -= left
            if chance <= 0:
                return down
    return mode


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows that each block gives to each shard; its sums are the sizes of both."""
    random, room, matrix = Random(seed), list(shards), []
    for size in blocks:
        open_room, row = sum(room), []
        for j, places in enumerate(room):
            open_room -= places
            taken = hypergeometric(random, places, open_room, size) if open_room else size
            row.append(taken)
            room[j] -= taken
            size -= taken
        matrix.append(row)
    return matrix


def _piece(order: Column, pieces: int) -> Column:
    """The piece of a hash, growing with the hash."""
    return F.least(F.floor((order / F.lit(2.0**64) + 0.5) * pieces), F.lit(pieces - 1)).cast("int")


def _ranked(rows: DataFrame, group: str, order: str, pieces: int, name: str) -> DataFrame:
    """The rows with their place from 0 in their group, by order; each task ranks one piece."""
    cut = rows.withColumn("piece", _piece(F.col(order), pieces))
    earlier = Window.partitionBy(group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut.groupBy(group, "piece").count().select(
        group, "piece", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first")
    )
    within = Window.partitionBy(group, "piece").orderBy(order, "doc_id", "size", "text_crc32")
    ranked = cut.withColumn("within", F.row_number().over(within) - 1).join(firsts, [group, "piece"])
    return ranked.withColumn(name, F.col("first") + F.col("within")).drop("piece", "first", "within")


def shard_rows(documents: DataFrame, shards: int, seed: int = 42, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of documents (doc_id, text).

    size is the UTF-8 bytes of the text plus 1 (null: 1), text_crc32 the CRC-32 of these bytes. Shards
    differ by one row at most, the first ones being larger; slot numbers a shard's rows from 0. The same
    rows and seed give the same result; rows that are alike in all three columns are exchangeable. Rows
    without doc_id count like others; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = written(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")),
        "rows",
    )
    of_row = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    placed = rows.select(
        "*",
        F.pmod(F.xxhash64(F.lit(seed), *of_row), F.lit(blocks)).cast("int").alias("block"),
        F.xxhash64(F.lit(seed + 1), *of_row).alias("local"),
        F.xxhash64(F.lit(seed + 2), *of_row).alias("final"),
    )
    counts = dict(placed.groupBy("block").count().collect())
    sizes = [counts.get(b, 0) for b in range(blocks)]
    total = sum(sizes)
    targets = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix(sizes, targets, seed)
    ends = [[sum(row[: j + 1]) for j in range(shards - 1)] for row in matrix]

    ranked = _ranked(placed, "block", "local", max(1, -(-total // (blocks * PIECE_ROWS))), "place")
    # The shard is the number of earlier shards whose share of the block ends at or before the place.
    of_shard = [F.array(*[F.lit(row[j]).cast("long") for row in ends]) for j in range(shards - 1)]
    shard = sum(((F.col("place") >= F.get(end, F.col("block"))).cast("int") for end in of_shard), F.lit(0))
    dealt = written(ranked.withColumn("shard", shard).drop("block", "local", "place"), "dealt")
    return _ranked(dealt, "shard", "final", max(1, -(-total // (shards * PIECE_ROWS))), "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
