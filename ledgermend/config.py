"""Periods, thresholds, driver categories and label wording of a reconciliation.

The defaults describe the fourth quarter of 2024. Another quarter is another
``ReconConfig``; no operator holds a date, limit or label of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from types import MappingProxyType


@dataclass(frozen=True)
class Period:
    """An inclusive date window, a set of month numbers, or both together.

    ``months`` alone ignores the year, which is only right for a table that
    holds a single year.
    """

    start: date | None = None
    end: date | None = None
    months: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        if (self.start is None) != (self.end is None):
            raise ValueError("a period needs both start and end, or neither")
        if self.start is None and not self.months:
            raise ValueError("a period needs a date window or month numbers")
        if self.start is not None and self.start > self.end:
            raise ValueError("a period must not end before it starts")

    def spanning(self, other: Period) -> Period:
        """The shortest period around both; without dates the months of either."""
        if self.start is None or other.start is None:
            return Period(months=tuple({*self.month_numbers(), *other.month_numbers()}))
        return Period(min(self.start, other.start), max(self.end, other.end))

    def month_numbers(self) -> tuple[int, ...]:
        """Month numbers that can occur in the period, at most twelve."""
        if self.start is None:
            return tuple(sorted(set(self.months)))
        first = self.start.year * 12 + self.start.month - 1
        last = self.end.year * 12 + self.end.month - 1
        spanned = {m % 12 + 1 for m in range(first, min(last, first + 11) + 1)}
        return tuple(sorted(spanned & set(self.months) if self.months else spanned))


@dataclass(frozen=True)
class Labels:
    # Wording of the result, the trailing blanks included.
    undecided: str = "N"
    need_to_label: str = "Need to label"
    both_present: str = "both present"
    immaterial: str = "Immaterial"
    starts_later: str = "Booked now, starts later"
    booked_previously: str = "Booked previously, starts now    "
    migration: str = "Migration"
    price_ramp: str = "Price Ramp"
    price_uplift: str = "Price Uplift"
    winback: str = "Winback"
    upsell_migration: str = "Upsell & Cross-sell Migration"
    reversal: str = "Reversal"
    loss_in_prior_period: str = "SF Loss in prior period"
    ledger_loss_in_prior_period: str = "DWH loss in prior period"


def _categories(**drivers: tuple[str, ...]) -> Mapping[str, tuple[str, ...]]:
    return MappingProxyType(drivers)


# Ledger categories behind each driver of a booking variance.
BOOKING_DRIVERS = _categories(
    migration=("Cross-sell - migration", "Up Sell - migration"),
    winback=("Win back Downgrade", "Win back Downsell", "Winback", "Lapsed Renewal"),
    price_ramp=("Price Ramp",),
    price_uplift=("Price Uplift",),
)

# Ledger categories behind each driver of a loss variance.
LOSS_DRIVERS = _categories(
    downsell_migration=("Downgrade - migration", "Downsell - migration"),
    reversal=(
        "Price Uplift Reversal",
        "Up Sell Reversal",
        "Price Ramp Reversal",
        "Cross-sell Reversal",
    ),
)


@dataclass(frozen=True)
class BookingRules:
    current: Period = Period(months=(10, 11, 12))
    prev1: Period = Period(months=(7, 8, 9))
    prev2: Period = Period(months=(4, 5, 6))
    drivers: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: BOOKING_DRIVERS)
    materiality: float = 1000.0
    late_start: date = date(2024, 12, 26)
    prior_tolerance: float = 1000.0
    driver_share: tuple[float, float] = (90.0, 110.0)
    combined_share: tuple[float, float] = (90.0, 110.0)


@dataclass(frozen=True)
class LossRules:
    current: Period = Period(months=(10, 11, 12))
    prev1: Period = Period(months=(7, 8, 9))
    prev2: Period = Period(months=(4, 5, 6))
    monthly: Period = Period(date(2024, 4, 1), date(2024, 9, 30))
    drivers: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: LOSS_DRIVERS)
    materiality: float = 100.0
    prior_share: tuple[float, float] = (95.0, 105.0)
    driver_share: tuple[float, float] = (90.0, 110.0)
    override_share: tuple[float, float] = (90.0, 110.0)
    monthly_share: tuple[float, float] = (95.0, 100.0)


@dataclass(frozen=True)
class ReconConfig:
    ledger_window: Period = Period(date(2024, 10, 31), date(2024, 12, 31))
    ledger_row_type: str = "Account Name Customer Bridge"
    bookings: BookingRules = BookingRules()
    losses: LossRules = LossRules()
    labels: Labels = Labels()
