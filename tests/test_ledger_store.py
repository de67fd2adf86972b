"""The incremental ledger store against the whole ledger."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgermend import LedgerStore, Period
from ledgermend.checks.roles import CONFIG, Tables, movement_ledger
from ledgermend.operators.rollups import ledger_rollup
from ledgermend.sources.ledger_store import day_sums

SCHEMA = "customer_id string, row_type string, snapshot_date date, bridge_account string, arr_usd double, arr_lcu double"
DRIVERS = CONFIG.losses.drivers
MONTHLY = CONFIG.losses.monthly


def made(seed: int, days: range, n: int = 3000) -> list[tuple]:
    chooser = random.Random(seed)
    first = date(1997, 4, 1)
    return [
        (
            chooser.choice(["hot", "hot", f"c{chooser.randrange(40)}", None]),
            chooser.choice(["line", "line", "other"]),
            first + timedelta(days=chooser.choice(days)),
            chooser.choice(["RF", "RO", "NO", None]),
            chooser.choice([None, 1, -1]) and chooser.uniform(-1, 1) * 10 ** chooser.randint(-3, 12),
            chooser.uniform(-1e6, 1e6),
        )
        for _ in range(n)
    ]


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_days_added_one_after_the_other(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "store"))
    parts = [spark.createDataFrame(made(k, range(90 * k, 90 * (k + 1))), SCHEMA).repartition(3 + k) for k in range(3)]
    for part in parts:
        store.add_days(part)
    whole = parts[0].union(parts[1]).union(parts[2])
    # Equal bits, not nearly equal amounts.
    assert rows(store.rollup(CONFIG, DRIVERS, MONTHLY)) == rows(ledger_rollup(whole, CONFIG, DRIVERS, MONTHLY)) != []
    quarter = Period(date(1997, 7, 1), date(1997, 8, 15))
    assert rows(store.rollup(CONFIG, DRIVERS, quarter)) == rows(ledger_rollup(whole, CONFIG, DRIVERS, quarter))


def test_a_day_added_again_replaces_itself(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "store"))
    old = spark.createDataFrame(made(1, range(0, 270)), SCHEMA)
    store.add_days(old)
    before = rows(store.rollup(CONFIG, DRIVERS, MONTHLY))
    store.add_days(old)
    assert rows(store.rollup(CONFIG, DRIVERS, MONTHLY)) == before
    day = date(1997, 4, 1) + timedelta(days=260)
    corrected = spark.createDataFrame([("c1", "line", day, "RF", -5.0, 1.0)], SCHEMA)
    store.add_days(corrected)
    whole = old.where(F.col("snapshot_date") != F.lit(day)).union(corrected)
    assert rows(store.rollup(CONFIG, DRIVERS, MONTHLY)) == rows(ledger_rollup(whole, CONFIG, DRIVERS, MONTHLY))


def test_queries_read_the_days_of_their_windows(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "store"))
    store.add_days(spark.createDataFrame(made(2, range(0, 400)), SCHEMA))
    frame = store.rollup(CONFIG, DRIVERS)
    scan = next(x for x in spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted").splitlines() if x.startswith("PartitionFilters"))
    assert "snapshot_date" in scan and "1997-10-01" in scan and "1998-01-01" in scan
    days = {row.snapshot_date for row in store.days().collect()}
    files = {date.fromisoformat(d) for f in frame.inputFiles() for d in re.findall(r"snapshot_date=([\d-]+)", f)}
    assert files and files <= days and len(files) <= len(days)


def test_sums_are_few_and_nothing_is_left_out(spark, tmp_path):
    odd = [(None, "line", None, None, 1.0, 1.0), ("a", "line", date(1997, 10, 2), None, None, None), ("a", "line", date(1997, 10, 2), "RF", float("nan"), float("inf"))]
    frame = spark.createDataFrame(made(3, range(0, 3), 5000) + odd, SCHEMA)
    assert day_sums(frame).count() < 2000
    store = LedgerStore(spark, str(tmp_path / "store"))
    store.add_days(frame)
    store.add_days(frame.where("false"))
    assert rows(store.rollup(CONFIG, DRIVERS, MONTHLY)) == rows(ledger_rollup(frame, CONFIG, DRIVERS, MONTHLY))


@pytest.mark.parametrize("monthly", [None, MONTHLY])
def test_the_drivers_tables(spark, data_root, tmp_path, monthly):
    ledger = movement_ledger(Tables(spark, str(data_root / "sf0.001")))
    store = LedgerStore(spark, str(tmp_path / "store"))
    store.add_days(ledger)
    assert rows(store.rollup(CONFIG, DRIVERS, monthly)) == rows(ledger_rollup(ledger, CONFIG, DRIVERS, monthly))


def test_a_delivery_writes_few_files(spark, tmp_path):
    """At most one file a day, and one more for each border between two tasks; days times tasks before."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # all 8 partitions stay, as with large tables
    try:
        LedgerStore(spark, str(tmp_path / "store")).add_days(spark.createDataFrame(made(4, range(0, 20), 6000), SCHEMA))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert 20 <= len(list((tmp_path / "store").rglob("*.parquet"))) <= 20 + 7


def test_months_from_few_files(spark, tmp_path):
    """One large day is shared by tasks, the rows are placed once, and the monthly losses are the whole ledger's."""
    frame = spark.createDataFrame(made(5, range(100, 103), 6000), SCHEMA)
    plan = day_sums(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("Exchange rangepartitioning") == 1
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        store = LedgerStore(spark, str(tmp_path / "store"))
        store.add_days(frame)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    files = list((tmp_path / "store").rglob("*.parquet"))
    assert 3 < len(files) <= 3 + 7
    assert rows(store.rollup(CONFIG, DRIVERS, MONTHLY)) == rows(ledger_rollup(frame, CONFIG, DRIVERS, MONTHLY)) != []
