"""Amount parsing, exact sums, periods, contracts and readers."""

from __future__ import annotations

import math
import random
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgermend import Period, ReconConfig, ReconInputs, conform, read_inputs, read_rejects, rejects
from ledgermend.functions.money import (
    parse_amount,
    parse_prefixed_amount,
    share_percent,
    total,
)
from ledgermend.functions.periods import in_period
from ledgermend.functions.rules import largest_of
from ledgermend.operators.drivers import driver_of
from ledgermend.operators.idlists import id_lists
from ledgermend.operators.rollups import booking_ids, booking_measures, losses_in_period, rollup
from ledgermend.sources.contracts import CONTRACTS, ROLE_CONTRACTS


def evaluate(spark, values, schema, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {schema}")
    return [row[1] for row in frame.select("i", expression).orderBy("i").collect()]


def test_prefixed_amounts(spark):
    texts = ["USD 1,234.50", "EUR-2,000", "GBP 7", "", "USD", "US", None, "USD 12x", "USD 1d"]
    found = evaluate(spark, texts, "string", parse_prefixed_amount(F.col("x")))
    assert found == [1234.5, -2000.0, 7.0, None, None, None, None, None, None]


def test_plain_amounts(spark):
    texts = ["-1,234.50", "12", "1e3", " .5 ", "", "abc", "Infinity", None, "1,2,3", "(5.00)", "12d"]
    found = evaluate(spark, texts, "string", parse_amount(F.col("x")))
    assert found == [-1234.5, 12.0, 1000.0, 0.5, None, None, math.inf, None, 123.0, None, None]
    assert math.isnan(evaluate(spark, ["NaN"], "string", parse_amount(F.col("x")))[0])


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("unit", [1e-12, 1e-6, 1.0, 1e9, 1e15])
def test_totals_drop_nothing(spark, unit, partitions):
    for value, rows in ((0.4 * unit, 5000), (unit / 3, 30_000)):
        frame = spark.range(rows, numPartitions=partitions).select(F.lit(value).alias("x"))
        assert frame.agg(total("x")).first()[0] == pytest.approx(value * rows, rel=1e-12, abs=0)


def test_totals_do_not_depend_on_order(spark):
    cents = [random.Random(5).randint(-(10**8), 10**8) for _ in range(5000)]
    values = [c / 100 for c in cents]
    for seed in range(3):
        random.Random(seed).shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
        assert frame.agg(total("x")).first()[0] == sum(cents) / 100
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(total("x")).first()[0] is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_of_no_numbers(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for values, want in (([5.0, math.nan], "nan"), ([1.0, math.inf], "inf"), ([1.0, -math.inf], "-inf"), ([1e18] * 20, "2e+19")):
            frame = spark.createDataFrame([(v,) for v in values], "x double")
            assert str(frame.agg(total("x")).first()[0]) == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_share_rounds_half_to_even(spark):
    frame = spark.createDataFrame(
        [(2210.0, 2000.0), (2230.0, 2000.0), (-5.0, 10.0), (1.0, 0.0), (None, 5.0)],
        "part double, whole double",
    )
    rows = frame.select(share_percent(F.col("part"), F.col("whole"))).collect()
    assert [row[0] for row in rows] == [110.0, 112.0, 50.0, 0.0, None]


def test_largest_prefers_the_candidate_named_first(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (3.0, 2.0)], "a double, b double")
    label = largest_of([(F.col("a"), "a"), (F.col("b"), "b")])
    assert [row[0] for row in frame.select(label).collect()] == ["a", "b", "a"]


def test_driver_of(spark):
    drivers = {"up": ("x", "y"), "down": ("z",)}
    found = evaluate(spark, ["x", "y", "z", "w", None], "string", driver_of(F.col("x"), drivers))
    assert found == ["up", "up", "down", None, None]


def test_period_includes_both_days(spark):
    period = Period(date(2024, 10, 31), date(2024, 12, 31))
    days = [date(2024, 10, 30), date(2024, 10, 31), date(2024, 12, 31), date(2025, 1, 1), None]
    assert evaluate(spark, days, "date", in_period(period, "x")) == [
        False,
        True,
        True,
        False,
        None,
    ]
    stamps = [datetime(2024, 10, 30, 23, 59), datetime(2024, 12, 31, 10), datetime(2025, 1, 1)]
    assert evaluate(spark, stamps, "timestamp", in_period(period, "x")) == [
        False,
        True,
        False,
    ]


def test_period_of_months(spark):
    days = [date(2020, 4, 2), date(2024, 6, 30), date(2024, 7, 1)]
    months = Period(months=(4, 5, 6))
    assert evaluate(spark, days, "date", in_period(months, "x")) == [True, True, False]
    both = Period(date(2024, 1, 1), date(2024, 12, 31), (4, 5, 6))
    assert evaluate(spark, days, "date", in_period(both, "x")) == [False, True, False]


def test_month_numbers():
    assert Period(date(2024, 11, 15), date(2025, 2, 1)).month_numbers() == (1, 2, 11, 12)
    assert Period(date(2020, 1, 1), date(2024, 1, 1)).month_numbers() == tuple(range(1, 13))
    assert Period(months=(9, 7, 7)).month_numbers() == (7, 9)
    assert Period(date(2024, 1, 1), date(2024, 6, 30), (6, 7)).month_numbers() == (6,)


def test_spanning_period():
    spring, autumn = (Period(date(2024, m, 1), date(2024, m + 1, 30)) for m in (4, 9))
    assert autumn.spanning(spring) == Period(date(2024, 4, 1), date(2024, 10, 30))
    assert autumn.spanning(Period(months=(1,))).month_numbers() == (1, 9, 10)


@pytest.mark.parametrize(
    "wrong",
    [
        {},
        {"start": date(2024, 1, 1)},
        {"start": date(2024, 2, 1), "end": date(2024, 1, 1)},
    ],
)
def test_wrong_periods(wrong):
    with pytest.raises(ValueError):
        Period(**wrong)


def test_conform_accepts_any_case_and_drops_the_rest(spark):
    frame = spark.createDataFrame(
        [(7, "bridge", "2024-12-31", "New", "12.5", 1, "extra")],
        "MASTER_CUSTOMER_ID long, type string, Snapshot_Date string, Bridge_Account string,"
        " arr_usd_ccfx string, baseline_arr_local_currency int, more string",
    )
    found = conform(frame, "movement_ledger")
    assert found.columns == [field.name for field in CONTRACTS["movement_ledger"]]
    assert found.first() == ("7", "bridge", date(2024, 12, 31), "New", 12.5, 1.0)


def test_conform_names_the_missing_column(spark):
    frame = spark.createDataFrame([("c", 1.0)], "customer_id string, loss_usd double")
    with pytest.raises(ValueError, match="loss_history.*Renewal Contract Start Date"):
        conform(frame, "loss_history")


HISTORY = "`Account Name: Master Customer ID` string, `Renewal Contract Start Date` string, `Loss Amount (USD)` string"


def test_unreadable_values_end_the_run_or_become_null(spark):
    frame = spark.createDataFrame([("c", "soon", "many")], HISTORY)
    assert conform(frame, "loss_history", strict=False).first() == ("c", None, None)
    with pytest.raises(Exception, match="loss_history.contract_start: cannot read 'soon'"):
        conform(frame, "loss_history").select("contract_start").collect()
    assert conform(frame, "loss_history").select("customer_id").first() == ("c",)


@pytest.mark.parametrize(
    ("text", "value"),
    [("(5.00)", None), ("1,200.50", 1200.5), ("12d", None), ("NaN", math.nan), ("12/30/2024", None), ("", None), (None, None)],
)
def test_number_texts(spark, text, value):
    frame = spark.createDataFrame([("c", "2024-12-30", text)], HISTORY)
    lenient = conform(frame, "loss_history", strict=False).first()["loss_usd"]
    assert lenient == value or (value != value and lenient != lenient)
    listed = [tuple(row) for row in rejects({"loss_history": frame}).collect()]
    if value is None and text is not None:
        assert listed == [("loss_history", "loss_usd", text, 1)]
        with pytest.raises(Exception, match="loss_usd"):
            conform(frame, "loss_history").collect()
    else:
        assert listed == [] and str(conform(frame, "loss_history").first()["loss_usd"]) == str(lenient)


def test_date_texts(spark):
    frame = spark.createDataFrame([("c", day, "1") for day in ("12/30/2024", "2024-12-30", "", "", None)], HISTORY)
    listed = {tuple(row) for row in rejects({"loss_history": frame}).collect()}
    assert listed == {("loss_history", "contract_start", "12/30/2024", 1), ("loss_history", "contract_start", "", 2)}


def test_amount_texts_are_checked_where_they_are_read(spark):
    schema = "mcid string, `Opportunity ID (18)` string, `Renewal Contract Start Date` date, amount string, `Renewal Baseline (converted)` double"
    frame = spark.createDataFrame([("c", "o", date(2024, 11, 1), "(5.00)", -5.0)], schema)
    with pytest.raises(Exception, match=r"amount_text: cannot read '\(5.00\)'"):
        losses_in_period(conform(frame, "loss_lines"), ReconConfig().losses.current).collect()
    assert losses_in_period(conform(frame, "loss_lines", strict=False), ReconConfig().losses.current).collect() == []


def test_columns_that_differ_only_in_case(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        frame = spark.createDataFrame([("a", "b", "n")], "customer_id string, CUSTOMER_ID string, name string")
        with pytest.raises(ValueError, match="differ only in case"):
            conform(frame, "booking_customers")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


WINDOW = Period(date(2024, 10, 1), date(2024, 12, 31))


@pytest.mark.parametrize(
    ("columns", "period", "rows"),
    [
        ("close_date", Period(months=(10, 11, 12)), 1),
        ("close_date", WINDOW, 1),
        ("close_month", Period(months=(10, 11, 12)), 1),
        ("close_month", WINDOW, None),
        ("", Period(months=(10, 11, 12)), None),
        ("", WINDOW, None),
    ],
)
def test_periods_of_bookings_by_the_columns_present(spark, columns, period, rows):
    stored = {"close_date": "DATE'2024-11-05' AS close_date", "close_month": "11 AS close_month"}
    made = [stored[columns]] if columns else []
    frame = spark.range(1).selectExpr(
        "'c' AS customer_id", "'o' AS opportunity_id", "5.0D AS recurring_revenue", "'USD 5' AS amount_local_text", "DATE'2024-11-05' AS start_date", *made
    )
    lines, rules = conform(frame, "booking_lines"), replace(ReconConfig().bookings, current=period)
    if rows is None:
        with pytest.raises(ValueError, match="the period needs a column"):
            booking_measures(lines, rules)
    else:
        assert rollup(booking_measures(lines, rules)).count() == rows
        assert id_lists([booking_ids(lines, rules)]).count() == rows


def test_inputs_come_from_folders_and_are_shared(spark, tmp_path):
    locations = {}
    for role, contract in ROLE_CONTRACTS.items():
        path = tmp_path / contract
        if not path.exists():
            fields = ", ".join(
                f"{field.name} {'date' if field.kind == 'day' else 'string'}"
                for field in CONTRACTS[contract]
            )
            spark.createDataFrame([], fields).write.parquet(str(path))
        locations[role] = str(path)
    inputs = read_inputs(spark, locations)
    assert isinstance(inputs, ReconInputs)
    assert inputs.booking_history_prev1 is inputs.booking_history_prev2
    assert read_rejects(spark, locations).collect() == []
    with pytest.raises(ValueError, match="audit_refs"):
        read_inputs(spark, {k: v for k, v in locations.items() if k != "audit_refs"})
