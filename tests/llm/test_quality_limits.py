"""Limits of the quality rules on groups that hold much junk, and on groups of any size."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgermend.llm.quality_rules import LIMITS, base_failed, distinct_texts, judged, limits, stats_of

SCHEMA = "doc_id long, lang string, source string, text string"


def text(seed: int, symbols: int) -> str:
    chooser = random.Random(seed)
    return " ".join([f"word{chooser.randrange(10**6)}" for _ in range(100 - symbols)] + ["#" * 9] * symbols)


def rejected(spark, rows) -> list[int]:
    docs = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], SCHEMA)
    counted = docs.withColumn("counts", stats_of(F.col("text")))
    return sorted(r.doc_id for r in judged(counted, "counts", "good").where("not good").collect())


def test_junk_copied_to_a_third_of_a_source(spark):
    plain = [("en", "one", text(k, 0)) for k in range(300)]
    assert rejected(spark, plain + [("en", "one", text(999, 45))] * 150) == list(range(300, 450))


def test_different_junk_in_a_third_of_a_source(spark):
    plain = [("en", "one", text(k, 0)) for k in range(300)]
    assert rejected(spark, plain + [("en", "one", text(1000 + k, 45)) for k in range(150)]) == list(range(300, 450))


def test_copies_move_no_limit(spark):
    """A usual text that is copied often does not make the others outliers."""
    rows = [("en", "one", text(k, k % 5)) for k in range(300)]
    assert rejected(spark, rows + [rows[0]] * 3000) == rejected(spark, rows) == []


@pytest.mark.parametrize("size", [1, 2, 20, 199, 201])
def test_tables_of_any_size_have_limits(spark, size):
    """Junk is rejected in a small table too, alone in its source and language or not, and every group has all limits."""
    rows = [("en", f"s{k % 3}", text(k, 0)) for k in range(size)]
    junk = [("en", "s0", text(999, 45)), ("en", "alone", text(998, 45)), ("de", "alone", text(997, 45))]
    found = rejected(spark, rows + junk)
    assert found == ([] if size < 3 else list(range(size, size + 3)))  # three are most of a table of four or five
    docs = spark.createDataFrame([(k, *row) for k, row in enumerate(rows + junk)], SCHEMA)
    passing = docs.withColumn("counts", stats_of(F.col("text"))).where(~base_failed("counts"))
    groups = limits(distinct_texts(passing, "counts"), "counts").collect()
    assert len(groups) == len({row[:2] for row in rows + junk})
    assert all(group.limits[name] is not None for group in groups for name in LIMITS)


def test_tables_counted_again_are_judged_alike(spark):
    rows = [("en", f"s{k % 7}", text(k, k % 3)) for k in range(60)] + [("en", "s0", text(999, 45))]
    once, again = rejected(spark, rows), rejected(spark, rows * 9)
    assert once == [60] and again == [60 + 61 * k for k in range(9)]
