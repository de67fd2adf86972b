"""The full reconciliation: both branches, merged, with audit references."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgermend.config import ReconConfig
from ledgermend.operators.idlists import IdList
from ledgermend.operators.merge import (
    attach_lists,
    attach_opportunities,
    merge_branches,
    with_report_headers,
)
from ledgermend.operators.rollups import booking_ids, loss_ids
from ledgermend.plans.bookings import labelled_bookings
from ledgermend.plans.combined import combined_branches
from ledgermend.plans.losses import labelled_losses
from ledgermend.sources.contracts import ReconInputs


def opportunity_ids(inputs: ReconInputs, config: ReconConfig) -> list[IdList]:
    return [
        booking_ids(inputs.booking_lines, config.bookings, "booking_ids"),
        loss_ids(inputs.loss_lines, config.losses, "loss_ids"),
    ]


def merged_branches(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """Both branch results side by side, a row per earlier month with losses."""
    merged = merge_branches(labelled_bookings(inputs, config), labelled_losses(inputs, config))
    return attach_opportunities(merged, opportunity_ids(inputs, config))


def audited_branches(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """The merged branches with audit ids, each row once.

    Repeated rows vanish here, so the losses need not carry every month.
    """
    return attach_lists(combined_branches(inputs, config), opportunity_ids(inputs, config), inputs.audit_refs)


def reconcile(inputs: ReconInputs, config: ReconConfig | None = None) -> DataFrame:
    """The report: one row per customer, two where earlier months disagree on the loss label."""
    return with_report_headers(audited_branches(inputs, config or ReconConfig()))
