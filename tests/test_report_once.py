"""The report by period: one computation serves all its writes."""

from __future__ import annotations

from ledgermend.checks import registry


def test_the_report_is_computed_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    report = spark.range(20).toDF(" id ").mapInArrow(counted, "` id ` long")
    monkeypatch.setattr(registry.roles, "inputs", lambda tables: None)
    monkeypatch.setattr(registry.reconciliation, "reconcile", lambda inputs, config: report)
    found = registry.STORED["report_by_period"](spark, "")
    assert found.columns == ["id", "period"]
    assert sorted(tuple(row) for row in found.collect()) == [(k, "1997Q4") for k in range(20)]
    assert seen.value == 20
