"""The driver's star-schema tables in the roles of a reconciliation.

Orders that are open or in progress act as booking lines, finished orders as
losses, and every order line as a movement of the ledger, negative when the
goods came back. Return flag and line status together form the ledger category.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.config import BookingRules, LossRules, Period, ReconConfig
from ledgermend.sources.contracts import ReconInputs, conform

CURRENT = Period(date(1997, 10, 1), date(1997, 12, 31))
HISTORY = Period(date(1990, 1, 1), date(2009, 12, 31))
"""The years that the driver's tables can have."""
PREV1 = Period(date(1997, 7, 1), date(1997, 9, 30))
PREV2 = Period(date(1997, 4, 1), date(1997, 6, 30))

# Order amounts are far larger than the default limits, so these are wider.
CONFIG = ReconConfig(
    ledger_window=CURRENT,
    ledger_row_type="line",
    bookings=BookingRules(
        current=CURRENT,
        prev1=PREV1,
        prev2=PREV2,
        drivers={
            "migration": ("NO",),
            "winback": ("AO",),
            "price_ramp": ("NF",),
            "price_uplift": ("AF",),
        },
        materiality=25_000.0,
        late_start=date(1997, 12, 15),
        prior_tolerance=25_000.0,
    ),
    losses=LossRules(
        current=CURRENT,
        prev1=PREV1,
        prev2=PREV2,
        monthly=Period(date(1997, 4, 1), date(1997, 9, 30)),
        drivers={"downsell_migration": ("RF",), "reversal": ("RO",)},
        materiality=25_000.0,
        prior_share=(80.0, 120.0),
        monthly_share=(80.0, 100.0),
    ),
)


QUARTERS = {name: Period(months=period.month_numbers()) for name, period in (("current", CURRENT), ("prev1", PREV1), ("prev2", PREV2))}
BY_MONTHS = replace(CONFIG, bookings=replace(CONFIG.bookings, **QUARTERS))
"""The same rules for bookings of the quarter's months in any year."""


@dataclass(frozen=True)
class Tables:
    """The driver's tables, each read once and only when a role needs it."""

    spark: SparkSession
    sf_dir: str

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def customer(self) -> DataFrame:
        return self._read("customer")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._read("lineitem")

    def sold_lines(self) -> DataFrame:
        """Order lines with their customer."""
        owner = self.orders.select("o_orderkey", "o_custkey")
        return self.lineitem.join(owner, F.expr("l_orderkey = o_orderkey"))


def customers(source: Tables) -> DataFrame:
    return source.customer.selectExpr("c_custkey AS customer_id", "c_name AS name")


def booking_lines(source: Tables) -> DataFrame:
    return conform(
        source.orders.where("o_orderstatus IN ('O', 'P')").selectExpr(
            "o_custkey AS customer_id",
            "o_orderkey AS opportunity_id",
            "o_orderdate AS close_date",
            "o_totalprice AS recurring_revenue",
            "concat('USD ', format_number(o_totalprice, 2)) AS amount_local_text",
            "o_orderdate AS start_date",
        ),
        "booking_lines",
    )


def loss_lines(source: Tables) -> DataFrame:
    return conform(
        source.orders.where("o_orderstatus = 'F'").selectExpr(
            "o_custkey AS customer_id",
            "o_orderkey AS opportunity_id",
            "o_orderdate AS contract_start",
            "format_number(-o_totalprice, 2) AS amount_text",
            "-o_totalprice AS baseline_converted",
        ),
        "loss_lines",
    )


def loss_history(source: Tables) -> DataFrame:
    return conform(
        source.orders.where("o_orderstatus = 'F'").selectExpr(
            "o_custkey AS customer_id", "o_orderdate AS contract_start", "-o_totalprice AS loss_usd"
        ),
        "loss_history",
    )


def movement_ledger(source: Tables) -> DataFrame:
    returned = "IF(l_returnflag = 'R', -1D, 1D)"
    return conform(
        source.sold_lines().selectExpr(
            "o_custkey AS customer_id",
            f"'{CONFIG.ledger_row_type}' AS row_type",
            "l_shipdate AS snapshot_date",
            "concat(l_returnflag, l_linestatus) AS bridge_account",
            f"{returned} * l_extendedprice * (1 - l_discount) AS arr_usd",
            f"{returned} * l_extendedprice AS arr_lcu",
        ),
        "movement_ledger",
    )


def audit_lines(source: Tables) -> DataFrame:
    """Supplier and line number of all order lines; line 7 stands for a missing contract."""
    return conform(
        source.sold_lines().selectExpr(
            "o_custkey AS customer_id",
            "l_suppkey AS reference_number",
            "nullif(l_linenumber, 7) AS contract_id",
        ),
        "audit_refs",
    )


def inputs(source: Tables) -> ReconInputs:
    spine = customers(source)
    ledger = movement_ledger(source)
    bookings = booking_lines(source)
    return ReconInputs(
        booking_customers=conform(spine, "booking_customers"),
        booking_lines=bookings,
        booking_history_prev1=bookings,
        booking_history_prev2=bookings,
        booking_ledger=ledger,
        loss_customers=conform(spine, "loss_customers"),
        loss_lines=loss_lines(source),
        loss_history=loss_history(source),
        loss_ledger=ledger,
        audit_refs=audit_lines(source),
    )


def export_texts(source: Tables) -> dict[str, DataFrame]:
    """Order exports as text; by their numbers, some hold what no contract can read."""
    booked = source.orders.where("o_orderstatus IN ('O', 'P')").selectExpr(
        "o_custkey AS customer_id",
        "o_orderkey AS opportunity_id",
        """CASE WHEN o_orderkey % 11 = 0 THEN format_string('%.2fd', o_totalprice)
            WHEN o_orderkey % 13 = 0 THEN '' ELSE format_number(o_totalprice, 2) END AS recurring_revenue""",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'USD' ELSE concat('USD ', format_number(o_totalprice, 2)) END AS amount_local_text",
        """CASE WHEN o_orderkey % 19 = 0 THEN date_format(o_orderdate, 'MM/dd/yyyy')
            ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS start_date""",
    )
    lost = source.orders.where("o_orderstatus = 'F'").selectExpr(
        "o_custkey AS customer_id",
        "o_orderkey AS opportunity_id",
        "o_orderdate AS contract_start",
        """CASE WHEN o_orderkey % 23 = 0 THEN '(5.00)' WHEN o_orderkey % 29 = 0 THEN 'NaN'
            ELSE format_number(-o_totalprice, 2) END AS amount_text""",
        "-o_totalprice AS baseline_converted",
    )
    return {"booking_lines": booked, "loss_lines": lost}


def odd_ids(source: Tables) -> DataFrame:
    """Order numbers as ids that hold blanks, commas, quotes, backslashes and braces, by their last digit."""
    return source.orders.selectExpr(
        "CAST(o_custkey AS STRING) AS customer_id",
        r"""CASE o_orderkey % 8 WHEN 0 THEN concat('a ', o_orderkey) WHEN 1 THEN '' WHEN 2 THEN 'null'
            WHEN 3 THEN concat('q"', o_orderkey) WHEN 4 THEN concat('b', chr(92), o_orderkey)
            WHEN 5 THEN concat('{', o_orderkey, ',}') WHEN 6 THEN NULL
            ELSE CAST(o_orderkey AS STRING) END AS reference_number""",
    )


def signed_lines(source: Tables) -> DataFrame:
    """Prefixed amounts, every third one negative, every seventh without customer."""
    return source.orders.selectExpr(
        "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS STRING) END AS customer_id",
        "concat('EUR ', format_number(IF(o_orderkey % 3 = 0, -o_totalprice, o_totalprice), 2)) AS text",
    )


def tied_drivers(source: Tables) -> DataFrame:
    """Driver amounts with many ties; shares of the gap end in .5 percent for odd amounts."""
    return source.orders.selectExpr(
        "o_orderkey AS order_id",
        "CAST(o_orderkey % 400 AS DOUBLE) AS ramp",
        "CAST(o_custkey % 400 AS DOUBLE) AS uplift",
        "CAST(greatest(o_orderkey % 400, o_custkey % 400) - o_orderkey % 2 AS DOUBLE) AS winback",
        "CAST(IF(o_orderkey % 11 = 0, 0, 200) AS DOUBLE) AS gap",
    )
