"""Every operator and plan as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.checks import roles
from ledgermend.checks.roles import BY_MONTHS, CONFIG, HISTORY, Tables
from ledgermend.config import Period, ReconConfig
from ledgermend.functions.money import parse_amount, parse_prefixed_amount, share_percent
from ledgermend.functions.periods import in_period
from ledgermend.functions.rules import largest_of
from ledgermend.operators import rollups
from ledgermend.operators.drivers import driver_of
from ledgermend.operators.idchunks import read_chunks, write_chunks
from ledgermend.operators.idlists import KEY, IdList, id_lists, with_lists
from ledgermend.operators.merge import audit_ids
from ledgermend.plans import bookings, losses, reconciliation
from ledgermend.sources.calendar import calendar, within_period
from ledgermend.sources.contracts import ReconInputs, rejects
from ledgermend.sources.ledger_store import LedgerStore
from ledgermend.sources.periods_sink import computed_once, read_periods, write_period
from ledgermend.sources.workspace import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STORED: dict[str, Query] = {}
"""Queries that write tables on the way, and so run jobs before their result is read."""

KEY_TEXT = "reference_number"


def _over_tables(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Registers a query on the driver's tables under the function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


def _stored(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Registers a query that writes tables on the way."""
    STORED[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


def _plan(name: str, build: Callable[[ReconInputs, ReconConfig], DataFrame], *unused: str) -> None:
    """Registers a plan over all roles, without its ``unused`` columns."""
    QUERIES[name] = lambda spark, sf_dir: build(
        roles.inputs(Tables(spark, sf_dir)), CONFIG
    ).drop(*unused)


@_over_tables
def amount_parse(tables: Tables) -> DataFrame:
    booked = roles.booking_lines(tables).select(
        "opportunity_id", parse_prefixed_amount(F.col("amount_local_text")).alias("amount")
    )
    lost = roles.loss_lines(tables).select(
        "opportunity_id", parse_amount(F.col("amount_text")).alias("amount")
    )
    return booked.unionByName(lost)


@_over_tables
def period_filter(tables: Tables) -> DataFrame:
    """Losses of the quarter's months in any year, marked where the year matches too."""
    quarter = Period(months=CONFIG.losses.current.month_numbers())
    lines = rollups.losses_in_period(roles.loss_lines(tables), quarter)
    return lines.select(
        KEY,
        "opportunity_id",
        F.col("contract_start").cast("date").alias("contract_start"),
        "loss_usd",
        in_period(CONFIG.losses.current, "contract_start").alias("in_window"),
    )


@_over_tables
def category_map(tables: Tables) -> DataFrame:
    category = F.col("bridge_account")
    return roles.movement_ledger(tables).select(
        KEY,
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        "bridge_account",
        driver_of(category, CONFIG.bookings.drivers).alias("booking_driver"),
        driver_of(category, CONFIG.losses.drivers).alias("loss_driver"),
    )


@_over_tables
def booking_rollup(tables: Tables) -> DataFrame:
    lines, rules = roles.booking_lines(tables), CONFIG.bookings
    return with_lists(rollups.rollup(rollups.booking_measures(lines, rules)), [rollups.booking_ids(lines, rules)])


@_over_tables
def loss_rollup(tables: Tables) -> DataFrame:
    lines, rules = roles.loss_lines(tables), CONFIG.losses
    return with_lists(rollups.rollup(rollups.loss_measures(lines, rules)), [rollups.loss_ids(lines, rules)])


@_over_tables
def prior_period_rollup(tables: Tables) -> DataFrame:
    history = roles.booking_lines(tables)
    return rollups.rollup(rollups.prior_booking_measures(history, history, CONFIG.bookings))


@_over_tables
def loss_history_rollup(tables: Tables) -> DataFrame:
    return rollups.rollup(
        rollups.loss_history_measures(roles.loss_history(tables), CONFIG.losses)
    )


@_over_tables
def ledger_rollup(tables: Tables) -> DataFrame:
    drivers = {**CONFIG.bookings.drivers, **CONFIG.losses.drivers}
    return rollups.ledger_rollup(roles.movement_ledger(tables), CONFIG, drivers)


@_over_tables
def ledger_monthly_losses(tables: Tables) -> DataFrame:
    folded = rollups.ledger_rollup(
        roles.movement_ledger(tables), CONFIG, CONFIG.losses.drivers, CONFIG.losses.monthly
    )
    return folded.selectExpr(KEY, "inline(monthly_losses) AS (month, month_arr_usd)")


@_over_tables
def id_list_text(tables: Tables) -> DataFrame:
    """All lines of all years; duplicates and missing ids stay in the lists."""
    refs = roles.audit_lines(tables)
    return id_lists([IdList(name, refs, name) for name in ("reference_number", "contract_id")])


@_over_tables
def id_list_distinct_text(tables: Tables) -> DataFrame:
    return id_lists(audit_ids(roles.audit_lines(tables)))


@_over_tables
def id_list_quoting(tables: Tables) -> DataFrame:
    """Ids that need quotes, empty ones, and the word that stands for a missing one."""
    return id_lists([IdList(KEY_TEXT, roles.odd_ids(tables), KEY_TEXT)])


@_over_tables
def signed_amounts(tables: Tables) -> DataFrame:
    """Prefixed amounts of both signs, and their totals with rows that have no customer."""
    lines = roles.signed_lines(tables)
    parsed = lines.withColumn("amount", parse_prefixed_amount(F.col("text")))
    return rollups.rollup([rollups.Measure("amount", parsed, F.lit(True), F.col("amount"))])


@_over_tables
def share_ties(tables: Tables) -> DataFrame:
    """Shares that lie between two percents, and largest drivers that are as large as another."""
    pairs = roles.tied_drivers(tables)
    drivers = [(F.col(name), name) for name in ("ramp", "uplift", "winback")]
    return pairs.select(
        "order_id",
        share_percent(F.col("ramp"), F.col("gap")).alias("share"),
        largest_of(drivers).alias("largest"),
    )


@_over_tables
def rejected_values(tables: Tables) -> DataFrame:
    return rejects(roles.export_texts(tables))


@_over_tables
def reconcile_bookings_by_months(tables: Tables) -> DataFrame:
    """The bookings branch with periods of month numbers, taken from the close dates."""
    return bookings.reconcile_bookings(roles.inputs(tables), BY_MONTHS)


@_over_tables
def calendar_filter(tables: Tables) -> DataFrame:
    """Losses of the quarter's months in any year, by the days of a calendar."""
    quarter = Period(months=CONFIG.losses.current.month_numbers())
    lost = roles.loss_lines(tables).withColumn("day", F.col("contract_start").cast("date"))
    found = within_period(lost, "day", quarter, calendar(tables.spark, HISTORY.start, HISTORY.end))
    return found.select(KEY, "opportunity_id", F.col("day").alias("contract_start"), parse_amount(F.col("amount_text")).alias("loss_usd")).where("loss_usd < 0")


def _ledger_store(tables: Tables) -> LedgerStore:
    """The ledger in a store that was filled in three deliveries, one of them twice."""
    store, ledger = LedgerStore(tables.spark, new_path(tables.spark, "ledger-store")), roles.movement_ledger(tables)
    for period in ("DATE'1997-07-01' <= snapshot_date", "DATE'1997-11-01' <= snapshot_date", "snapshot_date < DATE'1997-07-01'"):
        store.add_days(ledger.where(period))
    return store


@_stored
def ledger_store_rollup(tables: Tables) -> DataFrame:
    return _ledger_store(tables).rollup(CONFIG, {**CONFIG.bookings.drivers, **CONFIG.losses.drivers})


@_stored
def ledger_store_monthly_losses(tables: Tables) -> DataFrame:
    folded = _ledger_store(tables).rollup(CONFIG, CONFIG.losses.drivers, CONFIG.losses.monthly)
    return folded.selectExpr(KEY, "inline(monthly_losses) AS (month, month_arr_usd)")


@_stored
def drivers_by_table(tables: Tables) -> DataFrame:
    """The ledger rollup with its drivers from a mapping table, made from the categories that occur."""
    categories = roles.movement_ledger(tables).select(F.col("bridge_account").alias("category")).distinct()
    drivers = {**CONFIG.bookings.drivers, **CONFIG.losses.drivers}
    mapping = categories.withColumn("driver", driver_of(F.col("category"), drivers)).where("driver IS NOT NULL")
    return rollups.ledger_rollup_by_table(roles.movement_ledger(tables), CONFIG, mapping)


@_stored
def id_list_chunks(tables: Tables) -> DataFrame:
    """The lists of all order lines, written in chunks and put together again."""
    refs, path = roles.audit_lines(tables), new_path(tables.spark, "id-chunks")
    names = ("reference_number", "contract_id")
    write_chunks([IdList(name, refs, name) for name in names], path, chunk_rows=16, run=4)
    joined = "listagg(CASE WHEN list = {} THEN text END, ',') WITHIN GROUP (ORDER BY chunk)"
    return read_chunks(tables.spark, path).groupBy(KEY).agg(*(F.expr(joined.format(k)).alias(name) for k, name in enumerate(names)))


@_stored
def report_by_period(tables: Tables) -> DataFrame:
    """The report written to its quarter of a table, twice, and read again."""
    path = new_path(tables.spark, "report")
    with computed_once(reconciliation.reconcile(roles.inputs(tables), CONFIG)) as report:
        write_period(report, path, "1997Q3")
        for _ in range(2):
            write_period(report, path, "1997Q4", most_change=0.1)
    return read_periods(tables.spark, path, "1997Q4")


_plan("spine_variance", bookings.spine_variance, "prev1_usd", "prev2_usd")
_plan("bookings_stage1", bookings.materiality_stage, "prev1_usd", "prev2_usd")
_plan("bookings_stage2", bookings.prior_period_stage)
_plan("bookings_stage3", bookings.driver_stage)
_plan("reconcile_bookings", bookings.reconcile_bookings)
_plan("losses_stage1", losses.materiality_stage, "prev1_usd", "prev2_usd", "monthly_losses")
_plan("losses_stage2", losses.prior_period_stage, "monthly_losses")
_plan("losses_stage3", losses.driver_stage, "monthly_losses")
_plan("losses_stage4", losses.monthly_stage)
_plan("reconcile_losses", losses.reconcile_losses)
_plan("merge_branches", reconciliation.merged_branches)
_plan("attach_audit_refs", reconciliation.audited_branches)
_plan("reconciliation", reconciliation.reconcile)
