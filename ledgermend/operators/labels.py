"""The cause label of a variance, refined in stages.

Each stage reads the label of the stage before and, unless stated otherwise,
only replaces ``Labels.undecided``. Within a stage the first matching rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermend.config import BookingRules, Labels, LossRules
from ledgermend.functions.money import share_percent, within
from ledgermend.functions.rules import first_match, largest_of


def _undecided(labels: Labels) -> Column:
    return F.col("label") == labels.undecided


def booking_materiality(rules: BookingRules, labels: Labels) -> Column:
    both_positive = (F.col("crm_filled") > 0) & (F.col("arr_filled") > 0)
    starts_late = F.col("start_date") >= F.lit(rules.late_start)
    return first_match(
        [
            (both_positive & (F.col("abs_diff") < rules.materiality), labels.immaterial),
            (starts_late & (F.col("arr_filled") == 0), labels.starts_later),
        ],
        F.lit(labels.undecided),
    )


def booking_in_prior_period(rules: BookingRules, labels: Labels) -> Column:
    """Movement of a customer without a booking that an earlier booking explains."""
    unbooked = (F.col("crm_filled") == 0) & (F.col("arr_usd") > 0)

    def explained_by(prior: str) -> Column:
        gap = F.abs(F.col("arr_usd") - F.col(prior))
        return (F.col(prior) > 0) & (gap <= rules.prior_tolerance)

    earlier = explained_by("prev1_usd") | explained_by("prev2_usd")
    return first_match(
        [(_undecided(labels) & unbooked & earlier, labels.booked_previously)], F.col("label")
    )


def booking_driver(rules: BookingRules, labels: Labels) -> Column:
    """A single driver that explains the gap, else the largest of all that do together."""

    def explains(driver: str) -> Column:
        share = share_percent(F.col(driver), F.col("abs_diff"))
        return _undecided(labels) & within(share, rules.driver_share)

    all_drivers = (
        F.col("price_ramp") + F.col("price_uplift") + F.col("winback") + F.col("migration")
    )
    combined = F.try_divide(all_drivers, F.col("diff")) * 100.0
    largest = largest_of(
        [
            (F.col("price_ramp"), labels.price_ramp),
            (F.col("price_uplift"), labels.price_uplift),
            (F.col("winback"), labels.winback),
            (F.col("migration"), labels.upsell_migration),
        ]
    )
    one_sided = F.col("presence") == labels.need_to_label
    return first_match(
        [
            (explains("migration"), labels.migration),
            (explains("price_ramp"), labels.price_ramp),
            (explains("price_uplift"), labels.price_uplift),
            (explains("winback"), labels.winback),
            (_undecided(labels) & one_sided & within(combined, rules.combined_share), largest),
            (_undecided(labels), labels.need_to_label),
        ],
        F.col("label"),
    )


def loss_materiality(rules: LossRules, labels: Labels) -> Column:
    both_negative = (F.col("crm_filled") < 0) & (F.col("arr_filled") < 0)
    return first_match(
        [(both_negative & (F.col("abs_diff") < rules.materiality), labels.immaterial)],
        F.lit(labels.undecided),
    )


def loss_in_prior_period(rules: LossRules, labels: Labels) -> Column:
    """A gap that a loss booked in an earlier period explains, sign included."""

    def explained_by(prior: str) -> Column:
        share = F.try_divide(F.col(prior), F.col("diff")) * 100.0
        return within(share, rules.prior_share)

    earlier = explained_by("prev1_usd") | explained_by("prev2_usd")
    return first_match([(_undecided(labels) & earlier, labels.loss_in_prior_period)], F.col("label"))


def loss_driver(rules: LossRules, labels: Labels) -> Column:
    def explains(driver: str) -> Column:
        share = share_percent(F.col(driver), F.col("abs_diff"))
        return _undecided(labels) & within(share, rules.driver_share)

    return first_match(
        [
            (explains("downsell_migration"), labels.migration),
            (explains("reversal"), labels.reversal),
            (_undecided(labels), labels.need_to_label),
        ],
        F.col("label"),
    )


def month_explains(month_arr_usd: Column, rules: LossRules) -> Column:
    """Whether the ledger loss of an earlier month is about as large as the gap."""
    share = F.try_divide(F.abs(month_arr_usd), F.col("abs_diff")) * 100.0
    return F.coalesce(within(share, rules.monthly_share), F.lit(False))


def loss_override(rules: LossRules, labels: Labels) -> Column:
    """Both drivers together, which outrank any earlier label, else an earlier month's loss.

    Reads the outcome of one earlier month from ``month_explains``.
    """
    reversal, migration = F.abs("reversal"), F.abs("downsell_migration")
    share = F.try_divide(reversal + migration, F.col("abs_diff")) * 100.0
    larger = largest_of([(reversal, labels.reversal), (migration, labels.migration)])

    loss, movement = F.abs("crm_filled"), F.abs("arr_filled")
    underreported = (loss != 0) & ((movement == 0) | (loss > movement))
    unlabelled = F.col("label").isin(labels.undecided, labels.need_to_label, "")
    return first_match(
        [
            (within(share, rules.override_share), larger),
            (
                underreported & F.col("month_explains") & unlabelled,
                labels.ledger_loss_in_prior_period,
            ),
        ],
        F.col("label"),
    )
