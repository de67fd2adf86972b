"""Totals are the same bits in any order and partitioning."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgermend.functions.money import BIN_EXPONENTS, BINS, recombined, split, total


def bits(value):
    return None if value is None else struct.pack(">d", value)


def amounts(seed: int, n: int) -> list[float]:
    chooser = random.Random(seed)
    return [chooser.choice([-1, 1]) * chooser.random() * 10.0 ** chooser.randint(-9, 15) for _ in range(n)]


def rounded(exact: Fraction) -> float:
    """The exact total as a double of 13 significant digits."""
    return float(f"{float(exact):.12e}")


def frame_of(spark, values, partitions=3):
    rows = [(k % 7, v) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "g int, x double").repartition(partitions)


def test_equal_bits_in_any_partitioning(spark):
    values = amounts(1, 4000)
    found = set()
    for seed, partitions in ((1, 1), (2, 5), (3, 13)):
        pairs = [(k % 7, v) for k, v in enumerate(values)]
        random.Random(seed).shuffle(pairs)
        frame = spark.createDataFrame(pairs, "g int, x double").repartition(partitions)
        rows = frame.groupBy("g").agg(total("x").alias("t")).collect()
        found.add(tuple(sorted((r.g, bits(r.t)) for r in rows)))
    assert len(found) == 1


def test_totals_are_the_exact_ones(spark):
    values = amounts(2, 3000)
    rows = frame_of(spark, values).groupBy("g").agg(total("x").alias("t")).collect()
    for row in rows:
        exact = sum((Fraction(v) for k, v in enumerate(values) if k % 7 == row.g), Fraction(0))
        assert row.t == rounded(exact)


@pytest.mark.parametrize("partitions", [1, 4, 11])
def test_amounts_that_cancel_leave_nothing_behind(spark, partitions):
    """Large movements in and out, and what is left between them."""
    large = [1e15 * (k + 1) / 7 for k in range(500)]
    for rest, want in (([], 0.0), ([0.01], 0.01), ([1e-6, 2e-6], 3e-6)):
        values = [*large, *rest, *(-v for v in large)]
        random.Random(partitions).shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
        assert frame.agg(total("x")).first()[0] == want


def test_bins_are_exact_and_merge(spark):
    values = [0.1, -0.1, 1 / 3, 2.0**60 + 2.0**9, -(2.0**-43) / 3, 123456789.123, 5e-324, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    parts = frame.select("x", *[p.alias(f"p{k}") for k, p in enumerate(split(F.col("x")))]).collect()
    for row in parts:
        exact = sum((Fraction(row[f"p{k}"]) * Fraction(2) ** e for k, e in enumerate(BIN_EXPONENTS)), Fraction(0))
        assert abs(exact - Fraction(row.x)) <= Fraction(1, 2**97) and row[f"p{BINS - 1}"] is None
    # Sums of sums are sums.
    pieces = frame_of(spark, amounts(3, 700))
    names = [f"p{k}" for k in range(BINS)]
    by_group = pieces.select("g", *[p.alias(n) for n, p in zip(names, split(F.col("x")), strict=True)]).groupBy("g").agg(*[F.sum(n).alias(n) for n in names])
    merged = by_group.agg(recombined([F.sum(n) for n in names])).first()[0]
    assert bits(merged) == bits(pieces.agg(total("x")).first()[0])


def test_what_no_bin_holds(spark):
    def of(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(total("x")).first()[0]

    assert of(None) is None and of(None, 2.5) == 2.5 and of(-0.0) == 0.0
    assert math.isnan(of(1.0, math.nan)) and math.isnan(of(math.inf, -math.inf)) and of(1.0, -math.inf) == -math.inf
    assert of(1e40, 1.0) == 1e40 and of(1e29) == 1e29 and of(1e-9) == 1e-9 and abs(of(1e-20) - 1e-20) <= 2.0**-97
    assert of(123456789012345.0) == 123456789012300.0  # 13 digits
