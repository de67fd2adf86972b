"""Recurring-revenue reconciliation as Spark DataFrame transformations."""

from ledgermend.config import (
    BookingRules,
    Labels,
    LossRules,
    Period,
    ReconConfig,
)
from ledgermend.plans.bookings import reconcile_bookings
from ledgermend.plans.losses import reconcile_losses
from ledgermend.plans.reconciliation import reconcile
from ledgermend.sources.contracts import ReconInputs, conform, rejects
from ledgermend.sources.ledger_store import LedgerStore
from ledgermend.sources.periods_sink import read_periods, write_period
from ledgermend.sources.readers import read_inputs, read_rejects

__all__ = [
    "BookingRules",
    "Labels",
    "LedgerStore",
    "LossRules",
    "Period",
    "ReconConfig",
    "ReconInputs",
    "conform",
    "read_inputs",
    "read_periods",
    "read_rejects",
    "reconcile",
    "reconcile_bookings",
    "reconcile_losses",
    "rejects",
    "write_period",
]
