"""One row per customer from the source tables.

Every rollup is a hash aggregation with a map-side partial step, so a customer
that owns a large share of a table sends one partial row per task, not its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.config import BookingRules, LossRules, Period, ReconConfig
from ledgermend.functions.money import BINS, parse_amount, parse_prefixed_amount, recombined, split, total
from ledgermend.functions.periods import in_period
from ledgermend.operators.drivers import driver_of, mapping_of, with_driver
from ledgermend.operators.idlists import KEY, IdList, of_known_customers


def latest(day: str) -> Column:
    return F.max(F.col(day).cast("date"))


@dataclass(frozen=True)
class Measure:
    """``combine``, ``total`` or ``latest``, over ``value`` of the rows of ``source`` where ``when`` holds."""

    name: str
    source: DataFrame
    when: Column
    value: Column
    combine: Callable[[str], Column] = total


def rollup(measures: Sequence[Measure]) -> DataFrame:
    """All measures in one aggregation; sources given as the same object are scanned once.

    A measure is NULL for a customer without rows that count for it. Customers
    without a row for any measure are absent.
    """
    by_source: dict[int, list[Measure]] = {}
    for measure in measures:
        by_source.setdefault(id(measure.source), []).append(measure)

    def contribution(own: list[Measure]) -> DataFrame:
        conditions = {id(measure.when): measure.when for measure in own}
        only_one = len(conditions) == 1
        entries = [_entry(m) if only_one else F.when(m.when, _entry(m)) for m in own]
        return own[0].source.where(reduce(or_, conditions.values())).select(KEY, unfolded(entries))

    stacked = reduce(DataFrame.unionByName, map(contribution, by_source.values())).select(KEY, "entry.*").where("measure IS NOT NULL")
    added = stacked.groupBy(KEY, "measure").agg(total("amount").alias("amount"), F.max("day").alias("day"))
    return added.groupBy(KEY).agg(
        *(_measured(m.name, "day" if m.combine is latest else "amount").alias(m.name) for m in measures)
    )


def unfolded(entries: Sequence[Column]) -> Column:
    """A row for each entry, as the struct ``entry``.

    The outer form: Spark would compute the entries of the other one twice, to leave out rows that have none.
    """
    return F.explode_outer(F.array(*entries)).alias("entry")


def _entry(measure: Measure) -> Column:
    dated = measure.combine is latest
    amount = F.lit(None).cast("double") if dated else measure.value.cast("double")
    day = measure.value.cast("date") if dated else F.lit(None).cast("date")
    return F.struct(F.lit(measure.name).alias("measure"), amount.alias("amount"), day.alias("day"))


def _measured(name: str, column: str) -> Column:
    """The value of one measure among a customer's rows, one for each measure."""
    return F.max(F.when(F.col("measure") == name, F.col(column)))


def closed_in(lines: DataFrame, period: Period) -> Column:
    """Whether a booking line closed in the period, by the columns that the lines have.

    Month numbers come from ``close_month``, or else from ``close_date``; a date
    window needs ``close_date``.
    """
    needed = ["close_date"] if period.start else ["close_month", "close_date"]
    if not set(needed) & set(lines.columns):
        raise ValueError(f"bookings: the period needs a column {' or '.join(needed)}")
    return in_period(period, "close_date", "close_month" if "close_month" in lines.columns else None)


def booking_measures(lines: DataFrame, rules: BookingRules) -> list[Measure]:
    current = closed_in(lines, rules.current)
    return [
        Measure("booking_usd", lines, current, F.col("recurring_revenue")),
        Measure("booking_lcu", lines, current, parse_prefixed_amount(F.col("amount_local_text"))),
        Measure("start_date", lines, current, F.col("start_date"), latest),
    ]


def prior_booking_measures(
    prev1: DataFrame, prev2: DataFrame, rules: BookingRules
) -> list[Measure]:
    return [
        Measure("prev1_usd", prev1, closed_in(prev1, rules.prev1), F.col("recurring_revenue")),
        Measure("prev2_usd", prev2, closed_in(prev2, rules.prev2), F.col("recurring_revenue")),
    ]


def booking_ids(lines: DataFrame, rules: BookingRules, name: str = "opportunity_id") -> IdList:
    current = of_known_customers(lines).where(closed_in(lines, rules.current))
    return IdList(name, current, "opportunity_id")


def losses_in_period(lines: DataFrame, period: Period) -> DataFrame:
    """Loss lines of the period with a negative amount, parsed as ``loss_usd``."""
    return (
        lines.where(in_period(period, "contract_start"))
        .withColumn("loss_usd", parse_amount(F.col("amount_text")))
        .where("loss_usd < 0")
    )


def loss_measures(lines: DataFrame, rules: LossRules) -> list[Measure]:
    current = losses_in_period(lines, rules.current)
    any_row = F.lit(True)
    return [
        Measure("loss_usd", current, any_row, F.col("loss_usd")),
        Measure("loss_lcu", current, any_row, F.col("baseline_converted")),
    ]


def loss_history_measures(history: DataFrame, rules: LossRules) -> list[Measure]:
    def lost_in(period: Period) -> Column:
        return in_period(period, "contract_start")

    negative = history.where("loss_usd < 0")
    return [
        Measure("prev1_usd", negative, lost_in(rules.prev1), F.col("loss_usd")),
        Measure("prev2_usd", negative, lost_in(rules.prev2), F.col("loss_usd")),
    ]


def loss_ids(lines: DataFrame, rules: LossRules, name: str = "opportunity_id") -> IdList:
    current = losses_in_period(of_known_customers(lines), rules.current)
    return IdList(name, current, "opportunity_id")


LEDGER_PARTS = {side: [f"{side}_{k}" for k in range(BINS)] for side in ("usd", "lcu")}
"""Columns that hold the bins of both amounts of a ledger row, or of many rows added up."""


def ledger_rows(ledger: DataFrame) -> DataFrame:
    """Ledger rows with their amounts in bins, and whether they are losses."""
    parts = [
        part.alias(name)
        for side, amount in (("usd", "arr_usd"), ("lcu", "arr_lcu"))
        for name, part in zip(LEDGER_PARTS[side], split(F.col(amount)), strict=True)
    ]
    return ledger.select(KEY, "row_type", "snapshot_date", "bridge_account", (F.col("arr_usd") < 0).alias("loss"), *parts)


def ledger_totals(
    rows: DataFrame,
    config: ReconConfig,
    driver_maps: Sequence[Mapping[str, tuple[str, ...]]],
    monthly: Period | None = None,
    driver_columns: Sequence[str] = (),
) -> DataFrame:
    """Movement, the drivers of each map (as ``<map number>_<driver>``) and monthly losses in one pass.

    ``rows`` are ``ledger_rows`` or sums of them by customer, row type, day, category and sign. With ``driver_columns`` they
    have each map's driver already, in these columns, and of the maps only the names of the drivers count.
    """
    known = dict(enumerate(driver_columns))
    current = in_period(config.ledger_window, "snapshot_date")
    window, wanted = config.ledger_window, current
    named = [f"{k}_{name}" for k, drivers in enumerate(driver_maps) for name in drivers]
    usd, lcu = ([F.col(part).alias(f"part_{k}") for k, part in enumerate(LEDGER_PARTS[side])] for side in ("usd", "lcu"))

    def entry(measure: Column, when: Column, parts: list[Column]) -> Column:
        return F.when(when, F.struct(measure.alias("measure"), *parts))

    entries = [entry(F.lit("arr_usd"), current, usd), entry(F.lit("arr_lcu"), current, lcu)]
    for k, drivers in enumerate(driver_maps):
        driver = F.col(known[k]) if k in known else driver_of(F.col("bridge_account"), drivers)
        entries.append(entry(F.concat(F.lit(f"{k}_"), driver), current & driver.isNotNull(), usd))
    months = ()
    if monthly is not None:
        earlier = in_period(monthly, "snapshot_date") & F.col("loss")
        wanted = current | earlier
        entries.append(entry(F.concat(F.lit("month_"), F.month("snapshot_date").cast("string")), earlier, usd))
        months = monthly.month_numbers()
        # The scan may not be able to test the sign, hence cannot use the alternative
        # above; one window around both can always be pushed down.
        window = window.spanning(monthly)

    wanted_rows = rows.where(F.col("row_type") == config.ledger_row_type).where(in_period(window, "snapshot_date")).where(wanted)
    unfolded_rows = wanted_rows.select(KEY, unfolded(entries)).select(KEY, "entry.*").where("measure IS NOT NULL")
    amount = recombined([F.sum(f"part_{k}") for k in range(BINS)])
    added = unfolded_rows.groupBy(KEY, "measure").agg(amount.alias("amount"))
    totals = added.groupBy(KEY).agg(
        F.max(F.col("measure") == "arr_usd").alias("has_movement"),
        *(_measured(name, "amount").alias(name) for name in ("arr_usd", "arr_lcu", *named, *(f"month_{m}" for m in months))),
    )
    # A customer with movement but none for a driver has 0 there, not NULL.
    columns = [f"CASE WHEN has_movement THEN coalesce(`{name}`, 0D) END AS `{name}`" for name in named]
    if months:
        entries = ", ".join(
            f"CASE WHEN month_{m} IS NOT NULL"
            f" THEN named_struct('month', {m}, 'arr_usd', month_{m}) END"
            for m in months
        )
        columns.append(f"array_compact(array({entries})) AS monthly_losses")
    return totals.selectExpr(KEY, "arr_usd", "arr_lcu", *columns)


def ledger_rollup(
    ledger: DataFrame,
    config: ReconConfig,
    drivers: Mapping[str, tuple[str, ...]],
    monthly: Period | None = None,
) -> DataFrame:
    """Movement and driver amounts per customer in one pass over the ledger.

    With ``monthly``, the same pass also adds up the negative movement of each
    month of that earlier window; ``monthly_losses`` then holds one
    (month, arr_usd) entry per month that has any, and customers with earlier
    losses only get a row with NULL movement.
    """
    return with_driver_names(ledger_totals(ledger_rows(ledger), config, [drivers], monthly), drivers)


def with_driver_names(totals: DataFrame, drivers: Mapping[str, tuple[str, ...]], number: int = 0) -> DataFrame:
    """``ledger_totals`` with the drivers of one of its maps under their own names."""
    others = [name for name in totals.columns if "_" not in name or not name.split("_")[0].isdigit()]
    return totals.select(*others, *(F.col(f"`{number}_{name}`").alias(name) for name in drivers))


def ledger_rollup_by_table(ledger: DataFrame, config: ReconConfig, mapping: DataFrame, monthly: Period | None = None) -> DataFrame:
    """``ledger_rollup`` with the drivers of a mapping table (category, driver) of any size, which is joined."""
    checked = mapping_of(mapping)
    names = dict.fromkeys(sorted(row.driver for row in checked.select("driver").distinct().collect()), ())  # columns of the result
    rows = with_driver(ledger_rows(ledger), checked)
    return with_driver_names(ledger_totals(rows, config, [names], monthly, ["driver"]), names)
