"""Hand-derived cases for the default configuration, as source exports would hold them.

Every case is a customer of its own, so all cases run in one reconciliation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from ledgermend import ReconInputs, conform

ROW_TYPE = "Account Name Customer Bridge"
PREVIOUSLY = "Booked previously, starts now    "
DECEMBER = date(2024, 12, 31)


@dataclass
class Case:
    label: str | set[str] | None = None
    booking: float | None = None
    start: str = "2024-10-01"
    loss: float | None = None
    ledger: dict[str, float] = field(default_factory=dict)
    prev1: float | None = None
    prev2: float | None = None
    monthly: dict[int, float] = field(default_factory=dict)


BOOKINGS = {
    "b1": Case("Immaterial", 5000, ledger={"New": 5500}),
    "b2": Case("Need to label", 5000, ledger={"New": 6000}),
    "b3": Case("Booked now, starts later", 5000, start="2024-12-26"),
    "b4": Case("Need to label", 5000, start="2024-12-25"),
    "b5": Case(PREVIOUSLY, ledger={"New": 8000}, prev1=7000),
    "b6": Case(PREVIOUSLY, ledger={"New": 8000}, prev2=8500),
    "b6a": Case("Need to label", ledger={"New": 8000}, prev1=6999.99),
    "b7": Case("Migration", 1000, ledger={"Up Sell - migration": 10000, "New": 1000}),
    "b8": Case("Price Ramp", 1000, ledger={"Price Ramp": 10000, "New": 1000}),
    "b9": Case("Price Uplift", 1000, ledger={"Price Uplift": 10000, "New": 1000}),
    "b10": Case("Winback", 1000, ledger={"Lapsed Renewal": 10000, "New": 1000}),
    "b11": Case("Price Ramp", ledger={"Price Ramp": 6000, "Price Uplift": 4000}),
    "b12": Case("Price Ramp", ledger={"Price Ramp": 5000, "Winback": 5000}),
    "b13": Case(
        "Upsell & Cross-sell Migration", ledger={"Cross-sell - migration": 6000, "Winback": 4000}
    ),
    "b14": Case(
        "Need to label", 1000, ledger={"Price Ramp": 6000, "Price Uplift": 4000, "New": 1000}
    ),
    "b15": Case("Migration", ledger={"Up Sell - migration": 2210, "New": -210}),
    "b16": Case(None, ledger={"New": -500}),
    "b18": Case("Price Uplift", ledger={"Price Uplift": 5000, "Winback": 5000}),
    "b19": Case("Winback", ledger={"Win back Downgrade": 5000, "Cross-sell - migration": 5000}),
    "b20": Case("Need to label", ledger={"Price Ramp": 4000, "Winback": 4000, "New": 2000}),
}

LOSSES = {
    "c1": Case("Immaterial", loss=-500, ledger={"Loss": -550}),
    "c2": Case("Need to label", loss=-500, ledger={"Loss": -600}),
    "c3": Case("SF Loss in prior period", loss=-2000, ledger={"Loss": -6000}, prev1=-4000),
    "c4": Case("SF Loss in prior period", loss=-2000, ledger={"Loss": -6000}, prev2=-3800),
    "c5": Case("Need to label", loss=-6000, ledger={"Loss": -2000}, prev1=-4000),
    "c6": Case("Migration", loss=-2000, ledger={"Downsell - migration": -4000, "Loss": -2000}),
    "c7": Case("Reversal", loss=-2000, ledger={"Price Ramp Reversal": -4000, "Loss": -2000}),
    "c8": Case("Migration", loss=-500, ledger={"Downsell - migration": -50, "Loss": -500}),
    "c9": Case(
        "Migration",
        loss=-2000,
        ledger={"Downgrade - migration": -2400, "Up Sell Reversal": -1600, "Loss": -2000},
    ),
    "c10": Case(
        "Reversal",
        loss=-2000,
        ledger={"Downgrade - migration": -2000, "Up Sell Reversal": -2000, "Loss": -2000},
    ),
    "c11": Case("DWH loss in prior period", loss=-5000, monthly={8: -5000}),
    "c12": Case(
        {"DWH loss in prior period", "Need to label"}, loss=-5000, monthly={8: -5000, 9: -100}
    ),
    "c13": Case("Need to label", loss=-5000, monthly={8: -4700}),
    "c14": Case("Need to label", loss=-5000, monthly={8: -5100}),
    "c15": Case("DWH loss in prior period", loss=-6000, ledger={"Loss": -1000}, monthly={4: -4750}),
    "c16": Case("Need to label", loss=-1000, ledger={"Loss": -6000}, monthly={4: -5000}),
    "c17": Case(None, ledger={"Loss": 500}, monthly={4: -5000}),
    # An earlier label keeps its place when a month would explain the gap too.
    "c18": Case("Immaterial", loss=-500, ledger={"Loss": -450}, monthly={6: -48}),
    "c19": Case("Need to label", ledger={"Loss": -3000}),
}


def _ledger_rows(cases: dict[str, Case]) -> list[tuple]:
    rows = []
    for customer, case in cases.items():
        for category, amount in case.ledger.items():
            rows.append((customer, ROW_TYPE, DECEMBER, category, float(amount), amount * 2.0))
            # Rows of another type or outside the window never count.
            rows.append((customer, "Product Bridge", DECEMBER, category, 77777.0, 7.0))
            rows.append((customer, ROW_TYPE, date(2024, 10, 30), category, 77777.0, 7.0))
        for month, amount in case.monthly.items():
            rows.append((customer, ROW_TYPE, date(2024, month, 1), "Loss", amount / 2, 0.0))
            rows.append((customer, ROW_TYPE, date(2024, month, 30), "Loss", amount / 2, 0.0))
            rows.append((customer, ROW_TYPE, date(2024, month, 2), "New", 88888.0, 0.0))
    return rows


LEDGER_SCHEMA = (
    "master_customer_id string, Type string, snapshot_date date, Bridge_Account string,"
    " arr_usd_ccfx double, baseline_arr_local_currency double"
)


def build_inputs(spark, bookings=None, losses=None, extra_opportunities=(), audit=()):
    """Inputs under the export headers; ``losses`` may share customers with ``bookings``."""
    bookings = BOOKINGS if bookings is None else bookings
    losses = LOSSES if losses is None else losses

    def frame(table, rows, schema):
        return conform(spark.createDataFrame(rows, schema), table, strict=False)

    def spine(cases):
        return [(name, f"Name {name}") for name in cases] * 2 + [(None, "nobody")]

    lines = [
        (c, f"opp {c}", 11, str(b.booking), f"USD {b.booking:,.2f}", b.start)
        for c, b in bookings.items()
        if b.booking is not None
    ]
    # The latest start counts as a date, not as text; other months never count.
    lines += [(c, i, 10, "0", "EUR 0", "2024-9-1") for c, i in extra_opportunities]
    lines += [(c, "late", 1, "99999", "USD 99,999", "2024-12-31") for c in bookings]
    lines += [(None, "lost", 12, "5", "USD 5", "2024-12-31")]
    history = "`Master Customer ID` string, `Month # - Close Date` int, recurring_revenue double"
    return ReconInputs(
        booking_customers=frame(
            "booking_customers", spine(bookings), "epi_universal_id string, name string"
        ),
        booking_lines=frame(
            "booking_lines",
            lines,
            "`Master Customer ID` string, `Opportunity ID` string, `Month # - Close Date` int,"
            " recurring_revenue string, `Recurring Software Amount Change` string,"
            " `Celigo[AT]_Start Date` string",
        ),
        booking_history_prev1=frame(
            "booking_history",
            [(c, 8, float(b.prev1)) for c, b in bookings.items() if b.prev1 is not None]
            + [(c, 4, 55555.0) for c in bookings],
            history,
        ),
        booking_history_prev2=frame(
            "booking_history",
            [(c, 5, float(b.prev2)) for c, b in bookings.items() if b.prev2 is not None]
            + [(c, 9, 55555.0) for c in bookings],
            history,
        ),
        booking_ledger=frame("movement_ledger", _ledger_rows(bookings), LEDGER_SCHEMA),
        loss_customers=frame("loss_customers", spine(losses), "mcid string, name string"),
        loss_lines=frame(
            "loss_lines",
            [
                (c, f"loss {c}", date(2024, 11, 5), f"{x.loss:,.2f}", float(x.loss))
                for c, x in losses.items()
                if x.loss is not None
            ]
            + [(c, "gain", date(2024, 11, 6), "44,444.00", 44444.0) for c in losses]
            + [(c, "early", date(2024, 9, 30), "-44,444.00", -44444.0) for c in losses]
            + [(c, "broken", date(2024, 11, 6), "n/a", -1.0) for c in losses],
            "mcid string, `Opportunity ID (18)` string, `Renewal Contract Start Date` date,"
            " amount string, `Renewal Baseline (converted)` double",
        ),
        loss_history=frame(
            "loss_history",
            [(c, "2024-07-01", str(x.prev1)) for c, x in losses.items() if x.prev1 is not None]
            + [(c, "2024-06-30", str(x.prev2)) for c, x in losses.items() if x.prev2 is not None]
            + [(c, "2024-08-01", "33333") for c in losses]
            + [(c, "2024-03-31", "-33333") for c in losses],
            "`Account Name: Master Customer ID` string, `Renewal Contract Start Date` string,"
            " `Loss Amount (USD)` string",
        ),
        loss_ledger=frame("movement_ledger", _ledger_rows(losses), LEDGER_SCHEMA),
        audit_refs=frame(
            "audit_refs",
            list(audit) + [(None, "R0", "S0")],
            "master_customer_id string, reference_number string, salesforce_contract_id string",
        ),
    )
