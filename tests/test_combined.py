"""Both branches in one row per customer: equal results, and one pass over each table."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import pytest
from golden import BOOKINGS, LOSSES, build_inputs

from ledgermend import ReconConfig
from ledgermend.checks.roles import CONFIG, Tables, inputs
from ledgermend.operators.merge import merge_branches
from ledgermend.plans.bookings import labelled_bookings
from ledgermend.plans.combined import combined_branches
from ledgermend.plans.losses import labelled_losses


def apart(roles, config):
    return merge_branches(labelled_bookings(roles, config), labelled_losses(roles, config, every_month=False))


def rows(frame):
    return sorted(map(str, frame.distinct().collect()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_the_branches_merged(spark, data_root, sf):
    roles = inputs(Tables(spark, str(data_root / sf)))
    together, merged = combined_branches(roles, CONFIG), apart(roles, CONFIG)
    assert together.columns == merged.columns and rows(together) == rows(merged) != []


def test_golden_cases_of_separate_and_shared_customers(spark):
    """Ledgers of their own for both branches, then customers that both branches have."""
    alike = {f"x{k}": case for k, case in enumerate(LOSSES.values())}
    both = {f"x{k}": case for k, case in enumerate(BOOKINGS.values())}
    for roles in (build_inputs(spark), build_inputs(spark, both, alike)):
        assert rows(combined_branches(roles, ReconConfig())) == rows(apart(roles, ReconConfig()))


def test_several_names_of_a_customer(spark):
    roles = build_inputs(spark)
    twice = roles.booking_customers.selectExpr("customer_id", "IF(customer_id = 'b1', concat(name, ' Ltd'), name) AS name")
    unnamed = roles.loss_customers.selectExpr("customer_id", "IF(customer_id = 'c1', NULL, name) AS name")
    roles = replace(roles, booking_customers=roles.booking_customers.union(twice), loss_customers=unnamed)
    found = rows(combined_branches(roles, ReconConfig()))
    assert found == rows(apart(roles, ReconConfig()))
    assert sum("customer_id='b1'" in row for row in found) == 2


def test_a_category_of_drivers_in_both_branches(spark, data_root):
    """Each branch has its own driver for a category, under one name even."""
    rules = replace(CONFIG.losses, drivers={"downsell_migration": ("RF", "NO"), "reversal": ("RO", "AF")})
    config = replace(CONFIG, losses=rules)
    roles = inputs(Tables(spark, str(data_root / "sf0.001")))
    assert rows(combined_branches(roles, config)) == rows(apart(roles, config))


def test_one_pass_over_each_table(spark, data_root):
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        frame = combined_branches(inputs(Tables(spark, str(data_root / "sf0.001"))), CONFIG)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
    scans = Counter(re.findall(r"FileScan parquet \[(\w)_", plan))
    # Orders: as bookings, as losses, as earlier losses, and as owners of the ledger's lines.
    assert scans["l"] == 1 and scans["c"] <= 2 and scans["o"] <= 4
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+, \d+\)", plan)) == 3
    assert "FullOuter" not in plan
