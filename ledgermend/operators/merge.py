"""Both branches in one table, and the audit references next to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermend.functions.idtext import NULL_TEXT
from ledgermend.operators.idlists import KEY, IdList, of_known_customers, with_lists

# Result columns in order, with the headers of the report.
REPORT_HEADERS = {
    "customer_id": "MCID",
    "name": "Name",
    "arr_usd": "ARR USD TTL Customer Movement",
    "loss_usd": "SF Loss USD",
    "loss_variance_usd": "Loss Variance USD",
    "booking_usd": "SF Bookings USD",
    "booking_variance_usd": "Bookings Variance USD",
    "arr_lcu": " ARR LCU TTL Customer Movement ",
    "loss_lcu": "SF Loss LCU",
    "loss_variance_lcu": "Loss Variance LCU",
    "booking_lcu": "SF Bookings LCU",
    "booking_variance_lcu": "Bookings Variance LCU",
    "reference_number": "Reference number",
    "contract_id": "Salesforce Contract ID",
    "start_date": "Celigo Start Date",
    "opportunity_id": "Opportunity ID",
    "reversal": "Reversal",
    "upsell_migration": "(Upsell & Cross-sell Migration)",
    "downsell_migration": "(Downsell & Downgrade Migration)",
    "price_ramp": "Ramp",
    "price_uplift": "Price Uplift",
    "winback": "Win-Back",
    "loss_prev1_usd": "Loss in PrevQ1",
    "loss_prev2_usd": "Loss in PrevQ2",
    "booking_prev1_usd": "Bookings in PrevQ1",
    "booking_prev2_usd": "Bookings in PrevQ2",
    "loss_label": "Final Loss Recon Category",
    "booking_label": "Final Bookings Recon Category",
}


# Amounts of an absent side are 0; b is the bookings side, c the losses side.
_MERGED = {
    "customer_id": "coalesce(b.customer_id, c.customer_id)",
    "name": "coalesce(b.name, c.name)",
    "arr_usd": "coalesce(b.arr_usd, c.arr_usd, 0D)",
    "loss_usd": "coalesce(c.loss_usd, 0D)",
    "loss_variance_usd": "coalesce(c.diff, 0D)",
    "booking_usd": "coalesce(b.booking_usd, 0D)",
    "booking_variance_usd": "coalesce(b.diff, 0D)",
    "arr_lcu": "coalesce(b.arr_lcu, c.arr_lcu, 0D)",
    "loss_lcu": "coalesce(c.loss_lcu, 0D)",
    "loss_variance_lcu": "coalesce(c.arr_lcu - c.loss_lcu, 0D)",
    "booking_lcu": "coalesce(b.booking_lcu, 0D)",
    "booking_variance_lcu": "coalesce(b.arr_lcu - b.booking_lcu, 0D)",
    "start_date": "b.start_date",
    "reversal": "coalesce(c.reversal, 0D)",
    "upsell_migration": "coalesce(b.migration, 0D)",
    "downsell_migration": "coalesce(c.downsell_migration, 0D)",
    "price_ramp": "coalesce(b.price_ramp, 0D)",
    "price_uplift": "coalesce(b.price_uplift, 0D)",
    "winback": "coalesce(b.winback, 0D)",
    "loss_prev1_usd": "coalesce(c.prev1_usd, 0D)",
    "loss_prev2_usd": "coalesce(c.prev2_usd, 0D)",
    "booking_prev1_usd": "coalesce(b.prev1_usd, 0D)",
    "booking_prev2_usd": "coalesce(b.prev2_usd, 0D)",
    "loss_label": "c.label",
    "booking_label": "b.label",
}


def merged_columns(**own: str) -> list[str]:
    """The columns of the merged rows over a bookings side b and a losses side c; ``own`` gives some another rule."""
    return [f"{rule} AS {name}" for name, rule in {**_MERGED, **own}.items()]


def merge_branches(bookings: DataFrame, losses: DataFrame) -> DataFrame:
    """Full outer join of the branch results, one column list for both."""
    same_customer = F.expr("b.customer_id = c.customer_id")
    return (
        bookings.alias("b")
        .join(losses.alias("c"), same_customer, "full_outer")
        .selectExpr(*merged_columns())
    )


# The ids of a branch that a customer is absent from, and hence has no label of, do not count.
_OPPORTUNITIES = """coalesce(
    CASE WHEN booking_label IS NOT NULL THEN booking_ids END,
    CASE WHEN loss_label IS NOT NULL THEN loss_ids END)"""


def attach_opportunities(merged: DataFrame, opportunities: Sequence[IdList]) -> DataFrame:
    """The merged rows with the ids of their customer's bookings, or else losses.

    ``opportunities`` are the lists ``booking_ids`` and ``loss_ids``.
    """
    listed = with_lists(merged, opportunities)
    return listed.withColumn("opportunity_id", F.expr(_OPPORTUNITIES)).drop("booking_ids", "loss_ids")


def audit_ids(refs: DataFrame) -> list[IdList]:
    known = of_known_customers(refs)
    return [IdList(name, known, name, distinct=True) for name in ("reference_number", "contract_id")]


def attach_lists(merged: DataFrame, opportunities: Sequence[IdList], refs: DataFrame) -> DataFrame:
    """Distinct merged rows with the opportunity and audit ids of their customer.

    The lists depend on the customer alone and may be by far the widest columns,
    so they come last, all four in one pipeline: the placement by customer that ``merged`` has serves the removal
    of repeated rows and the join, and no list is shuffled or compared again.
    """
    listed = attach_opportunities(merged.distinct(), [*opportunities, *audit_ids(refs)])
    missing = {name: f"coalesce({name}, '{NULL_TEXT}')" for name in ("reference_number", "contract_id")}
    return listed.selectExpr(*(f"{missing.get(name, name)} AS {name}" for name in REPORT_HEADERS))


def with_report_headers(result: DataFrame) -> DataFrame:
    return result.selectExpr(
        *(f"{name} AS `{header}`" for name, header in REPORT_HEADERS.items())
    )
