"""Both branches in one row per customer: every table is read and placed once.

Customers of both branches, all CRM sources and the ledger are three aggregations by customer, joined where they lie. Both
labels are made in that row, so the branches meet without a full outer join, and a ledger that both name is read, shuffled and
added up once. What a branch can have several of, names and outcomes of earlier months, is unfolded last.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.config import ReconConfig
from ledgermend.operators.idlists import KEY
from ledgermend.operators.labels import (
    booking_driver,
    booking_in_prior_period,
    booking_materiality,
    loss_driver,
    loss_in_prior_period,
    loss_materiality,
    loss_override,
    month_explains,
)
from ledgermend.operators.merge import merged_columns
from ledgermend.operators.rollups import (
    booking_measures,
    ledger_rows,
    ledger_totals,
    loss_history_measures,
    loss_measures,
    prior_booking_measures,
    rollup,
)
from ledgermend.operators.variance import both_spines, has_sign, with_gap
from ledgermend.plans import bookings, losses
from ledgermend.sources.contracts import ReconInputs

BOOKED = ("booking_usd", "booking_lcu", "start_date", "prev1_usd", "prev2_usd")
LOST = ("loss_usd", "loss_lcu", "prev1_usd", "prev2_usd")
MOVED = ("arr_usd", "arr_lcu")


def crm_amounts(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """All CRM amounts of both branches, ``b_`` and ``c_``, in one aggregation."""
    booked = booking_measures(inputs.booking_lines, config.bookings)
    booked += prior_booking_measures(inputs.booking_history_prev1, inputs.booking_history_prev2, config.bookings)
    lost = loss_measures(inputs.loss_lines, config.losses) + loss_history_measures(inputs.loss_history, config.losses)
    return rollup([replace(m, name=f"b_{m.name}") for m in booked] + [replace(m, name=f"c_{m.name}") for m in lost])


def ledger_amounts(inputs: ReconInputs, config: ReconConfig) -> list[DataFrame]:
    """Movement and drivers of both branches, ``b_`` and ``c_``, and monthly losses; one table if both have the same ledger."""
    maps, monthly = (config.bookings.drivers, config.losses.drivers), config.losses.monthly
    months = F.col("monthly_losses").alias("c_monthly_losses")

    def named(side: str, number: int, drivers: Mapping) -> list[Column]:
        columns = [F.col(name).alias(f"{side}_{name}") for name in MOVED]
        return columns + [F.col(f"`{number}_{name}`").alias(f"{side}_{name}") for name in drivers]

    if inputs.booking_ledger is inputs.loss_ledger:
        both = ledger_totals(ledger_rows(inputs.booking_ledger), config, maps, monthly)
        return [both.select(KEY, *named("b", 0, maps[0]), *named("c", 1, maps[1]), months)]
    of_bookings = ledger_totals(ledger_rows(inputs.booking_ledger), config, maps[:1])
    of_losses = ledger_totals(ledger_rows(inputs.loss_ledger), config, maps[1:], monthly)
    return [of_bookings.select(KEY, *named("b", 0, maps[0])), of_losses.select(KEY, *named("c", 0, maps[1]), months)]


def _as_branch(joined: DataFrame, side: str, crm: tuple[str, ...], drivers: Mapping, zero: tuple[str, ...]) -> DataFrame:
    """The columns of one side under the names that the labels read, those in ``zero`` with 0 for NULL."""
    columns = {name: F.col(f"{side}_{name}") for name in (*crm, *MOVED, *drivers)}
    columns |= {name: F.coalesce(columns[name], F.lit(0.0)) for name in zero}
    return joined.withColumns(columns)


def _packed(names: tuple[str, ...]) -> Column:
    return F.struct(*(name for name in names if name not in (KEY, "name")))


def combined_branches(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """The merged rows of both branches, a row for each outcome of the earlier months, as from ``merge_branches``."""
    labels = config.labels
    joined = both_spines(inputs.booking_customers, inputs.loss_customers)
    for amounts in (crm_amounts(inputs, config), *ledger_amounts(inputs, config)):
        joined = joined.join(amounts, KEY, "left")
    of_losses = [name for name in joined.columns if name.startswith("c_")]

    rules = config.bookings
    booked = with_gap(_as_branch(joined, "b", BOOKED, rules.drivers, ("booking_lcu", "prev1_usd", "prev2_usd")), "booking_usd")
    booked = booked.withColumn("presence", bookings.presence(labels))
    for label in (booking_materiality, booking_in_prior_period, booking_driver):
        booked = booked.withColumn("label", label(rules, labels))
    present = (F.size("b_names") > 0) & has_sign(">")
    row = booked.select(KEY, "b_names", *of_losses, F.when(present, _packed(bookings.BRANCH_COLUMNS)).alias("b"))

    rules = config.losses
    lost = with_gap(_as_branch(row, "c", LOST, rules.drivers, ("loss_lcu",)), "loss_usd")
    for label in (loss_materiality, loss_in_prior_period, loss_driver):
        lost = lost.withColumn("label", label(rules, labels))
    filled = {name: F.coalesce(name, F.lit(0.0)) for name in ("prev1_usd", "prev2_usd")}
    lost = lost.withColumns(filled).withColumn("c_present", (F.size("c_names") > 0) & has_sign("<"))
    lost = lost.where("b IS NOT NULL OR c_present")
    # A month only matters through whether its loss explains the gap.
    outcomes = F.array_distinct(F.transform("c_monthly_losses", lambda entry: month_explains(entry["arr_usd"], rules)))
    lost = lost.withColumn("month_explains", F.explode_outer(F.when(F.col("c_present"), outcomes)))
    lost = lost.withColumn("label", loss_override(rules, labels))
    row = lost.select(KEY, "b_names", "c_names", "b", F.when(F.col("c_present"), _packed(losses.BRANCH_COLUMNS)).alias("c"))

    for side in "bc":
        kept = [name for name in row.columns if name != f"{side}_names"]
        row = row.select(*kept, F.explode_outer(F.when(F.col(side).isNotNull(), F.col(f"{side}_names"))).alias(f"{side}_name"))
    sides = [_named(side, columns) for side, columns in (("b", bookings.BRANCH_COLUMNS), ("c", losses.BRANCH_COLUMNS))]
    return row.select(KEY, *sides).selectExpr(*merged_columns(customer_id=KEY))


def _named(side: str, columns: tuple[str, ...]) -> Column:
    """A side's struct with customer and name, as the branch itself would have it."""
    own = {KEY: F.col(KEY), "name": F.col(f"{side}_name.name")}
    fields = [own.get(name, F.col(f"{side}.{name}")).alias(name) for name in columns]
    return F.when(F.col(side).isNotNull(), F.struct(*fields)).alias(side)
