"""Registered queries against their SQL, and the pipeline."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from ledgermend.llm.queries import ORACLE_SQL, QUERIES
from ledgermend.llm.store import table, written

TABLES = ("documents", "pages", "labels", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, data_root, name, sf):
    where = str(data_root / sf)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{where}/{t}.parquet')")
    result = db.execute(ORACLE_SQL[name])
    names = [column[0] for column in result.description]
    want = sorted((tuple(row) for row in result.fetchall()), key=repr)
    got = QUERIES[name](spark, where)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(row) for row in got.select(names).collect()), key=repr) == want


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, data_root):
    where = str(data_root / "sf0.01")
    docs = table(spark, where, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, where), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1] > 0.6 * counts[0]
    good = table(spark, where, "labels").where("quality = 1")
    first = written(corpus_pipeline.quality_classifier(spark, table(spark, where, "documents"), where), "first")
    assert first.join(good, "doc_id", "left_semi").count() >= 0.99 * good.count()
    pieces = corpus_pipeline.packing(spark, docs, where)
    assert pieces.select("doc_id").distinct().count() == counts[-1]


def test_stages_take_odd_rows(spark, odd, none, data_root):
    where = str(data_root / "sf0.001")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, where)
            rows = out.collect()
            assert name == "packing" or out.columns == docs.columns
            assert len(rows) <= docs.count() or name == "packing"
            if docs is none:
                assert rows == []


def test_near_copies_leave_one(spark, odd):
    rows = corpus_pipeline.near_duplicates(spark, odd, "")
    ids = [r.doc_id for r in rows.collect()]
    assert ids.count(0) == 1 and not {1, 2, 3} & set(ids) and 4 in ids and ids.count(None) == 3


def test_unlike_texts_of_one_doc_id_stay(spark):
    texts = ["one two three four five six seven", "other words that are here alone now", "a third text with words of its own"]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[0]), (1, texts[0])], "doc_id long, text string")
    rows = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2])])


def test_exact_dedup_stage_runs_again_alike(spark, odd):
    first, second = (corpus_pipeline.exact_dedup(spark, odd, "").collect() for _ in range(2))
    assert sorted(map(str, first)) == sorted(map(str, second)) != []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index_")]


def test_quality_rules_stage_counts_texts_once(spark, odd):
    plan = corpus_pipeline.quality_rules(spark, odd, "")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
