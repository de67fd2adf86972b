"""CRM losses against negative ledger movement, per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermend.config import ReconConfig
from ledgermend.operators.idlists import KEY, with_lists
from ledgermend.operators.labels import (
    loss_driver,
    loss_in_prior_period,
    loss_materiality,
    loss_override,
    month_explains,
)
from ledgermend.operators.rollups import (
    ledger_rollup,
    loss_history_measures,
    loss_ids,
    loss_measures,
    rollup,
)
from ledgermend.operators.variance import with_variance
from ledgermend.sources.contracts import ReconInputs

BRANCH_COLUMNS = (
    KEY,
    "name",
    "arr_usd",
    "arr_lcu",
    "loss_usd",
    "diff",
    "loss_lcu",
    "prev1_usd",
    "prev2_usd",
    "downsell_migration",
    "reversal",
    "label",
)


def spine_variance(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """Customers with losses, earlier losses and ledger movement side by side."""
    rules = config.losses
    lost = loss_measures(inputs.loss_lines, rules)
    lost_before = loss_history_measures(inputs.loss_history, rules)
    return with_variance(
        inputs.loss_customers,
        rollup(lost + lost_before),
        ledger_rollup(inputs.loss_ledger, config, rules.drivers, rules.monthly),
        crm_usd="loss_usd",
        sign="<",
    ).withColumn("loss_lcu", F.expr("coalesce(loss_lcu, 0D)"))


def materiality_stage(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return spine_variance(inputs, config).withColumn(
        "label", loss_materiality(config.losses, config.labels)
    )


def prior_period_stage(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return materiality_stage(inputs, config).withColumn(
        "label", loss_in_prior_period(config.losses, config.labels)
    )


def driver_stage(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    return prior_period_stage(inputs, config).withColumns(
        {
            "label": loss_driver(config.losses, config.labels),
            "prev1_usd": F.expr("coalesce(prev1_usd, 0D)"),
            "prev2_usd": F.expr("coalesce(prev2_usd, 0D)"),
        }
    )


def monthly_stage(
    inputs: ReconInputs, config: ReconConfig, every_month: bool = True
) -> DataFrame:
    """One row per customer and earlier month with ledger losses, or one without a month.

    The months travel with the ledger rollup, so this fan-out needs no join. A
    month only matters through whether its loss explains the gap; without
    ``every_month`` a customer has one row per outcome, two at most, and no
    month columns.
    """
    rules = config.losses
    staged = driver_stage(inputs, config)
    if every_month:
        months = staged.selectExpr("*", "inline_outer(monthly_losses) AS (month, month_arr_usd)")
        explained = months.withColumn(
            "month_explains", month_explains(F.col("month_arr_usd"), rules)
        )
    else:
        outcomes = F.transform(
            "monthly_losses", lambda entry: month_explains(entry["arr_usd"], rules)
        )
        explained = staged.withColumn(
            "month_explains", F.explode_outer(F.array_distinct(outcomes))
        )
    return explained.withColumn("label", loss_override(rules, config.labels)).drop(
        "monthly_losses", "month_explains"
    )


def labelled_losses(
    inputs: ReconInputs, config: ReconConfig, every_month: bool = True
) -> DataFrame:
    return monthly_stage(inputs, config, every_month).select(*BRANCH_COLUMNS)


def reconcile_losses(inputs: ReconInputs, config: ReconConfig) -> DataFrame:
    """The labelled customers with their loss ids, repeated as in ``monthly_stage``."""
    ids = loss_ids(inputs.loss_lines, config.losses)
    return with_lists(labelled_losses(inputs, config), [ids])
