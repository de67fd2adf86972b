"""Identifier lists in chunks, and as bitmaps."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgermend.operators import idbitmaps
from ledgermend.operators.idchunks import read_chunks, write_chunks
from ledgermend.operators.idlists import IdList, id_lists


@pytest.fixture(scope="module")
def ids(spark):
    """One customer owns most ids, a third of them the same one; some are NULL or need quotes."""
    return spark.range(12_000).select(
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 < 9, F.expr("'c' || id % 97")).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, "same").when(F.col("id") % 101 == 1, "a b").otherwise(F.expr("'' || id % 3919")).alias("ref"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("gap"),
    )


def whole_lists(ids, distinct):
    known = ids.where("customer_id IS NOT NULL")
    lists = [IdList(name, known, name, distinct) for name in ("ref", "gap")]
    return lists, {row[0]: row[1:] for row in id_lists(lists).collect()}


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize(("chunk_rows", "run"), [(7, 3), (1024, 64)])
def test_chunks_are_the_list(spark, ids, tmp_path, distinct, chunk_rows, run):
    lists, want = whole_lists(ids, distinct)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_chunks(lists, str(tmp_path / "chunks"), chunk_rows, run)
        write_chunks(lists, str(tmp_path / "chunks"), chunk_rows, run)  # a repeated call replaces what it wrote
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = read_chunks(spark, str(tmp_path / "chunks")).collect()
    found: dict = {}
    for row in sorted(rows, key=lambda r: (r.customer_id, r.list, r.chunk)):
        texts = found.setdefault(row.customer_id, [None, None])
        before = texts[row.list]
        assert row.chars == len(row.text) and row.offset == (0 if before is None else len(before) + 1)
        texts[row.list] = row.text if before is None else f"{before},{row.text}"
    assert {customer: tuple(texts) for customer, texts in found.items()} == {c: tuple(t) for c, t in want.items()}
    assert max(row.text.count(",") + 1 for row in rows) <= chunk_rows * run
    hot = [r for r in rows if r.customer_id == "hot" and r.list == 0]
    assert sorted(r.chunk for r in hot) == list(range(len(hot))) and (len(hot) > 50 if run == 3 else len(hot) >= 1)


def test_small_lists_are_one_chunk(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", None)], "customer_id string, x string")
    write_chunks([IdList("x", rows, "x")], str(tmp_path / "chunks"))
    got = sorted((r.customer_id, r.chunk, r.offset, r.text) for r in read_chunks(spark, str(tmp_path / "chunks")).collect())
    assert got == [("a", 0, 0, "1,2"), ("b", 0, 0, "NULL")]


def test_bitmaps_of_periods_are_the_distinct_list(spark, ids, tmp_path):
    lists, want = whole_lists(ids, True)
    chosen = random.Random(3).randrange(2, 9)
    for k, name in enumerate(("ref", "gap")):
        words = idbitmaps.dictionary(ids, name, str(tmp_path / name))
        assert sorted(r.number for r in words.collect()) == list(range(1, words.count() + 1))
        periods = [ids.where(f"coalesce(gap, 0) % {chosen} = {j}") for j in range(chosen)]
        maps = idbitmaps.merged(*(idbitmaps.bitmaps(period, name, words) for period in periods))
        lists = id_lists([IdList(name, idbitmaps.expanded(maps, words), "id", distinct=True)])
        assert {row[0]: row[1] for row in lists.collect()} == {customer: texts[k] for customer, texts in want.items()}
        counted = {row.customer_id: row.ids for row in idbitmaps.id_counts(maps).collect()}
        plain = {r[0]: r[1] for r in ids.where("customer_id IS NOT NULL").groupBy("customer_id").agg(F.countDistinct(name)).collect()}
        assert counted == plain


def test_numbers_beyond_one_bitmap(spark, tmp_path):
    ids = spark.range(70_000).selectExpr("'c' || id % 3 AS customer_id", "format_string('%06d', id) AS x")
    words = idbitmaps.dictionary(ids, "x", str(tmp_path / "words"))
    maps = idbitmaps.bitmaps(ids, "x", words)
    assert maps.select("bucket").distinct().count() == 3
    assert sorted(map(tuple, idbitmaps.expanded(maps, words).collect())) == sorted((r.customer_id, r.x) for r in ids.collect())


def test_ids_without_a_number_are_refused(spark, tmp_path):
    one = spark.createDataFrame([("a", "1")], "customer_id string, x string")
    other = spark.createDataFrame([("a", "2")], "customer_id string, x string")
    words = idbitmaps.dictionary(one, "x", str(tmp_path / "words"))
    with pytest.raises(Exception, match="no number for id 2"):
        idbitmaps.bitmaps(other, "x", words).collect()
