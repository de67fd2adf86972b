"""Labels, merge and identifier lists on hand-derived cases."""

from __future__ import annotations

import pytest
from golden import BOOKINGS, LOSSES, Case, build_inputs

from ledgermend import ReconConfig, reconcile, reconcile_bookings, reconcile_losses


def labels_by_customer(rows):
    found = {}
    for row in rows:
        found.setdefault(row["customer_id"], []).append(row["label"])
    return found


@pytest.fixture(scope="module")
def booking_rows(spark):
    return reconcile_bookings(build_inputs(spark), ReconConfig()).collect()


@pytest.fixture(scope="module")
def loss_rows(spark):
    return reconcile_losses(build_inputs(spark), ReconConfig()).collect()


@pytest.mark.parametrize("name", BOOKINGS)
def test_booking_label(name, booking_rows):
    expected = BOOKINGS[name].label
    assert labels_by_customer(booking_rows).get(name) == (None if expected is None else [expected])


@pytest.mark.parametrize("name", LOSSES)
def test_loss_label(name, loss_rows):
    expected = LOSSES[name].label
    if expected is None:
        wanted = None
    else:
        wanted = sorted(expected) if isinstance(expected, set) else [expected]
    found = labels_by_customer(loss_rows).get(name)
    assert (sorted(found) if found else None) == wanted


def test_no_customer_without_id(booking_rows, loss_rows):
    assert None not in labels_by_customer(booking_rows)
    assert None not in labels_by_customer(loss_rows)


def test_latest_start_is_compared_as_date(spark):
    inputs = build_inputs(
        spark,
        bookings={"x": Case(booking=5000, start="2024-12-30")},
        extra_opportunities=[("x", "older")],
    )
    (row,) = reconcile_bookings(inputs, ReconConfig()).collect()
    assert str(row["start_date"]) == "2024-12-30"
    assert row["label"] == "Booked now, starts later"


@pytest.fixture(scope="module")
def report(spark):
    bookings = {
        "only_b": Case(booking=5000, ledger={"New": 5500}),
        "both": Case(booking=100, ledger={"Price Ramp": 900}),
        "ids": Case(booking=10),
        "ledger_only": Case(ledger={"New": 50}),
    }
    losses = {
        "only_c": Case(loss=-500, ledger={"Loss": -550}),
        "both": Case(loss=-300, ledger={"Loss": -40}),
        "no_lcu": Case(loss=-700),
        "c12": Case(loss=-5000, monthly={7: -100, 8: -5000, 9: -200}),
        "same_months": Case(loss=-5000, monthly={7: -1, 8: -2, 9: -3}),
    }
    inputs = build_inputs(
        spark,
        bookings,
        losses,
        extra_opportunities=[
            ("ids", i) for i in ("y", None, "y", "", "null", 'q"u\\o', "a,b", "{z}", "NULLS")
        ],
        audit=[
            ("both", None, "S2"),
            ("both", "B", "S2"),
            ("both", "A", "S1"),
            ("both", "A", None),
            ("only_c", None, None),
        ],
    )
    rows = reconcile(inputs).collect()
    return {(row["MCID"], row["Final Loss Recon Category"]): row for row in rows}


def test_columns_in_order(report):
    row = next(iter(report.values()))
    # Headers of the report.
    assert list(row.asDict()) == [
        "MCID",
        "Name",
        "ARR USD TTL Customer Movement",
        "SF Loss USD",
        "Loss Variance USD",
        "SF Bookings USD",
        "Bookings Variance USD",
        " ARR LCU TTL Customer Movement ",
        "SF Loss LCU",
        "Loss Variance LCU",
        "SF Bookings LCU",
        "Bookings Variance LCU",
        "Reference number",
        "Salesforce Contract ID",
        "Celigo Start Date",
        "Opportunity ID",
        "Reversal",
        "(Upsell & Cross-sell Migration)",
        "(Downsell & Downgrade Migration)",
        "Ramp",
        "Price Uplift",
        "Win-Back",
        "Loss in PrevQ1",
        "Loss in PrevQ2",
        "Bookings in PrevQ1",
        "Bookings in PrevQ2",
        "Final Loss Recon Category",
        "Final Bookings Recon Category",
    ]


def test_bookings_only(report):
    row = report["only_b", None]
    assert row["SF Bookings USD"] == 5000 and row["Bookings Variance USD"] == 500
    assert row["SF Loss USD"] == row["Loss Variance USD"] == row["Loss in PrevQ1"] == 0
    assert row["Final Bookings Recon Category"] == "Immaterial"
    assert row["Bookings Variance LCU"] == 11000 - 5000


def test_losses_only(report):
    row = report["only_c", "Immaterial"]
    assert row["SF Loss USD"] == -500 and row["Loss Variance USD"] == -50
    assert row["SF Bookings USD"] == row["Ramp"] == row["SF Bookings LCU"] == 0
    assert row["Final Bookings Recon Category"] is None
    assert row["Celigo Start Date"] is None
    assert row["Opportunity ID"] == '"loss only_c"'


def test_customer_on_both_sides(report):
    row = report["both", "Need to label"]
    assert row["ARR USD TTL Customer Movement"] == 900
    assert row["Opportunity ID"] == '"opp both"'
    assert row["SF Loss USD"] == -300 and row["SF Bookings USD"] == 100
    assert row["Reference number"] == "A,B,NULL"
    assert row["Salesforce Contract ID"] == "S1,S2,NULL"


def test_loss_without_local_movement(report):
    row = report["no_lcu", "Need to label"]
    assert row["SF Loss LCU"] == -700 and row["Loss Variance LCU"] == 0


def test_customer_without_audit_row(report):
    row = report["only_b", None]
    assert (row["Reference number"], row["Salesforce Contract ID"]) == ("NULL", "NULL")
    row = report["only_c", "Immaterial"]
    assert (row["Reference number"], row["Salesforce Contract ID"]) == ("NULL", "NULL")


def test_opportunity_ids_as_text(report):
    expected = ['""', "NULLS", '"a,b"', '"null"', '"opp ids"', '"q\\"u\\\\o"', "y", "y", '"z"']
    assert report["ids", None]["Opportunity ID"] == ",".join([*expected, "NULL"])
    assert report["ledger_only", None]["Opportunity ID"] is None


def test_months_that_disagree_give_two_rows(report):
    assert ("c12", "DWH loss in prior period") in report and ("c12", "Need to label") in report
    assert [key for key in report if key[0] == "same_months"] == [("same_months", "Need to label")]
    assert len(report) == 4 + 5 - 1 + 1


def test_every_month_is_kept_in_the_branch(spark):
    losses = {"c": Case(loss=-5000, monthly={7: -100, 8: -5000, 9: -200})}
    inputs = build_inputs(spark, {}, losses)
    rows = reconcile_losses(inputs, ReconConfig()).collect()
    assert sorted(row["label"] for row in rows) == [
        "DWH loss in prior period",
        "Need to label",
        "Need to label",
    ]
