from __future__ import annotations

import hashlib
import re

from ledgermend.llm.exact_dedup import DigestIndex, deduplicate, kept_documents
from ledgermend.llm.store import new_path


def sha(text: str | None) -> str:
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def test_odd_rows(spark, odd, odd_rows):
    got = deduplicate(odd, DigestIndex(spark, new_path(spark, "index-test"))).collect()
    assert len(got) == len(odd_rows)
    groups: dict = {}
    for row in odd_rows:
        groups.setdefault(sha(row[1]), []).append((-len(row[1] or ""), row[0] is None, row[0] or 0, row[0]))
    for row in got:
        members = groups[row.text_sha256]
        assert row.group_size == len(members) and row.keep_id == min(members)[3]
        assert not row.kept or row.doc_id == row.keep_id
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(groups)


def test_rows_that_stay(spark, odd, odd_rows, none):
    stay = kept_documents(odd, DigestIndex(spark, new_path(spark, "index-test")))
    assert stay.columns == odd.columns
    rows = stay.collect()
    assert sorted(sha(r.text) for r in rows) == sorted({sha(r[1]) for r in odd_rows})
    assert 2 in {r.doc_id for r in rows} and 0 not in {r.doc_id for r in rows}  # the longer copy
    assert kept_documents(none, DigestIndex(spark, new_path(spark, "index-test"))).collect() == []


def test_new_data_meets_the_index(spark):
    path = new_path(spark, "index-test")

    def batch(*rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    index = DigestIndex(spark, path, buckets=4)
    assert deduplicate(batch(), index).collect() == []
    first = deduplicate(batch((5, "a b"), (3, "ab"), (4, "c")), index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in first} == {(5, 5, True), (3, 5, False), (4, 4, True)}
    again = DigestIndex(spark, path, buckets=4)
    spark.sql(f"DROP TABLE {again.name}")  # a new session opens the index by its path
    second = deduplicate(batch((1, "a  b"), (2, "d"), (7, "d ")), again).collect()
    assert {(r.doc_id, r.keep_id, r.kept, r.group_size) for r in second} == {(1, 5, False, 1), (2, 7, False, 2), (7, 7, True, 2)}
    assert sorted(r.keep_id for r in again.open().collect()) == [4, 5, 7]


def test_the_index_is_not_shuffled(spark):
    index = DigestIndex(spark, new_path(spark, "index-test"), buckets=8)
    deduplicate(spark.range(100).selectExpr("id as doc_id", "string(id) as text"), index).collect()
    new = spark.range(50).selectExpr("unhex(sha2(string(id), 256)) as digest").distinct()
    plan = new.hint("merge").join(index.open(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("FileScan") - 400 :]
    assert "SortMergeJoin" in plan and "Bucketed: true" in side and plan.count("Exchange hashpartitioning") == 1


def test_no_python_in_the_plan(spark, odd):
    found = deduplicate(odd, DigestIndex(spark, new_path(spark, "index-test")))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_repeated_batch_changes_nothing(spark, odd):
    """A driver that fails after the append and runs again gets the same rows and leaves the same index."""
    index = DigestIndex(spark, new_path(spark, "index-test"), buckets=4)
    known = spark.createDataFrame([(900, "one"), (901, "not in the batch")], "doc_id long, text string")
    deduplicate(known, index, "before").collect()
    results, states = [], []
    for _ in range(3):
        results.append(sorted(map(str, deduplicate(odd, index).collect())))
        states.append(sorted(map(str, index.open().collect())))
    assert results[0] == results[1] == results[2] and states[0] == states[1] == states[2]
    assert sum("kept=True" in row for row in results[0]) == len(states[0]) - 2
    one = [r for r in deduplicate(odd, index).collect() if r.doc_id == 8]
    assert [(r.keep_id, r.kept) for r in one] == [(900, False)]
    named = sorted(map(str, deduplicate(odd, index, "again's").collect()))
    assert not any("kept=True" in row for row in named)  # another batch, whose texts are all known
    index.close()
