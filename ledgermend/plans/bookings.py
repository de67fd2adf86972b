"""CRM bookings against positive ledger movement, per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.config import Labels, ReconConfig
from ledgermend.operators.idlists import KEY, with_lists
from ledgermend.operators.labels import (
    booking_driver,
    booking_in_prior_period,
    booking_materiality,
)
from ledgermend.operators.rollups import (
    booking_ids,
    booking_measures,
    ledger_rollup,
    prior_booking_measures,
    rollup,
)
from ledgermend.operators.variance import with_variance
from ledgermend.sources.contracts import ReconInputs

BRANCH_COLUMNS = (
    KEY,
    "name",
    "arr_usd",
    "arr_lcu",
    "booking_usd",
    "start_date",
    "diff",
    "booking_lcu",
    "prev1_usd",
    "prev2_usd",
    "migration",
    "price_ramp",
    "price_uplift",
    "winback",
    "label",
)


def presence(labels: Labels) -> Column:
    """Whether both a booking and a movement exist, or one of them is missing."""
    one_side_missing = F.expr("(booking_usd IS NULL) <> (arr_usd IS NULL)")
    return F.when(one_side_missing, labels.need_to_label).otherwise(labels.both_present)


def spine_variance(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """Customers with bookings, earlier bookings and ledger movement side by side."""
    rules, labels = config.bookings, config.labels
    booked = booking_measures(inputs.booking_lines, rules)
    booked_before = prior_booking_measures(
        inputs.booking_history_prev1, inputs.booking_history_prev2, rules
    )
    return with_variance(
        inputs.booking_customers,
        rollup(booked + booked_before),
        ledger_rollup(inputs.booking_ledger, config, rules.drivers),
        crm_usd="booking_usd",
        sign=">",
    ).withColumns(
        {
            "booking_lcu": F.expr("coalesce(booking_lcu, 0D)"),
            "prev1_usd": F.expr("coalesce(prev1_usd, 0D)"),
            "prev2_usd": F.expr("coalesce(prev2_usd, 0D)"),
            "presence": presence(labels),
        }
    )


def materiality_stage(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return spine_variance(inputs, config).withColumn(
        "label", booking_materiality(config.bookings, config.labels)
    )


def prior_period_stage(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return materiality_stage(inputs, config).withColumn(
        "label", booking_in_prior_period(config.bookings, config.labels)
    )


def driver_stage(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return prior_period_stage(inputs, config).withColumn(
        "label", booking_driver(config.bookings, config.labels)
    )


def labelled_bookings(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return driver_stage(inputs, config).select(*BRANCH_COLUMNS)


def reconcile_bookings(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """The labelled customers with the ids of their bookings."""
    ids = booking_ids(inputs.booking_lines, config.bookings)
    return with_lists(labelled_bookings(inputs, config), [ids])
