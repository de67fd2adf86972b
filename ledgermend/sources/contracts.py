"""Input tables: which columns are read, under which headers, as which type."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermend.functions.money import parse_amount, parse_prefixed_amount

TEXT = "text"
NUMBER = "number"
MONTH = "month"
DAY = "day"

_TYPES = {TEXT: "STRING", NUMBER: "DOUBLE", MONTH: "INT", DAY: "DATE"}


@dataclass(frozen=True)
class Field:
    """A column of a contract; ``parse`` reads the number that its text must hold."""

    name: str
    kind: str
    header: str | None = None
    required: bool = True
    parse: Callable[[Column], Column] | None = None


def _readable(column: Column, field: Field, stored: T.DataType) -> Column | None:
    """What an unreadable text of ``column`` has as NULL; None where every value can be read."""
    if not isinstance(stored, T.StringType):
        return None
    if field.kind == TEXT:
        return field.parse(column) if field.parse else None
    return parse_amount(column) if field.kind == NUMBER else column.try_cast(_TYPES[field.kind])


def _as_kind(column: Column, field: Field, stored: T.DataType) -> Column:
    if field.kind == DAY and isinstance(stored, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        # Left as stored, so that filters reach the scan.
        return column
    if field.kind == DAY and not isinstance(stored, T.StringType):
        raise ValueError(f"{field.name}: expected a date, got {stored.simpleString()}")
    readable = None if field.kind == TEXT else _readable(column, field, stored)
    return column.cast(_TYPES[field.kind]) if readable is None else readable


# The headers under which the source exports carry each column.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "booking_lines": (
        Field("customer_id", TEXT, "Master Customer ID"),
        Field("opportunity_id", TEXT, "Opportunity ID"),
        Field("close_month", MONTH, "Month # - Close Date", required=False),
        Field("close_date", DAY, required=False),
        Field("recurring_revenue", NUMBER),
        Field("amount_local_text", TEXT, "Recurring Software Amount Change", parse=parse_prefixed_amount),
        Field("start_date", DAY, "Celigo[AT]_Start Date"),
    ),
    "booking_history": (
        Field("customer_id", TEXT, "Master Customer ID"),
        Field("close_month", MONTH, "Month # - Close Date", required=False),
        Field("close_date", DAY, required=False),
        Field("recurring_revenue", NUMBER),
    ),
    "movement_ledger": (
        Field("customer_id", TEXT, "master_customer_id"),
        Field("row_type", TEXT, "Type"),
        Field("snapshot_date", DAY),
        Field("bridge_account", TEXT),
        Field("arr_usd", NUMBER, "arr_usd_ccfx"),
        Field("arr_lcu", NUMBER, "baseline_arr_local_currency"),
    ),
    "booking_customers": (
        Field("customer_id", TEXT, "epi_universal_id"),
        Field("name", TEXT),
    ),
    "loss_customers": (
        Field("customer_id", TEXT, "mcid"),
        Field("name", TEXT),
    ),
    "loss_lines": (
        Field("customer_id", TEXT, "mcid"),
        Field("opportunity_id", TEXT, "Opportunity ID (18)"),
        Field("contract_start", DAY, "Renewal Contract Start Date"),
        Field("amount_text", TEXT, "amount", parse=parse_amount),
        Field("baseline_converted", NUMBER, "Renewal Baseline (converted)"),
    ),
    "loss_history": (
        Field("customer_id", TEXT, "Account Name: Master Customer ID"),
        Field("contract_start", DAY, "Renewal Contract Start Date"),
        Field("loss_usd", NUMBER, "Loss Amount (USD)"),
    ),
    "audit_refs": (
        Field("customer_id", TEXT, "master_customer_id"),
        Field("reference_number", TEXT),
        Field("contract_id", TEXT, "salesforce_contract_id"),
    ),
}


def _matches(df: DataFrame, table: str) -> Iterator[tuple[Field, Column, T.DataType]]:
    """The contract's fields with the column that holds each; optional ones without column are left out."""
    stored: dict[str, list[T.StructField]] = {}
    for field in df.schema:
        stored.setdefault(field.name.lower(), []).append(field)
    for field in CONTRACTS[table]:
        names = dict.fromkeys([field.name.lower()] + ([field.header.lower()] if field.header else []))
        found = next((stored[name] for name in names if name in stored), None)
        if found is None and field.required:
            raise ValueError(f"{table}: no column {' or '.join(map(repr, filter(None, (field.name, field.header))))}")
        if found is None:
            continue
        if len(found) > 1:
            raise ValueError(f"{table}: columns differ only in case: {', '.join(repr(f.name) for f in found)}")
        yield field, F.col("`" + found[0].name.replace("`", "``") + "`"), found[0].dataType


def conform(df: DataFrame, table: str, strict: bool = True, observation: Observation | None = None) -> DataFrame:
    """The columns of ``table``'s contract, renamed and typed, nothing else.

    A column is found under its neutral name or its export header, in any
    case. A text that is no number, month or date where one is expected ends the
    run when a query needs it; without ``strict`` it counts as NULL, and
    ``rejects`` lists such texts.

    An ``observation`` gets the number of such texts by column from the run that reads the table, without a second pass, and
    ``rows``, the rows it saw. Filters stay above what is observed, so that run reads all rows of the columns it needs.
    """
    if observation is not None:
        unread = {
            field.name: F.count(F.when(column.isNotNull() & readable.isNull(), 1))
            for field, column, stored in _matches(df, table)
            if (readable := _readable(column, field, stored)) is not None
        }
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *(count.alias(name) for name, count in unread.items()))
    columns = []
    for field, column, stored in _matches(df, table):
        value = _as_kind(column, field, stored)
        readable = _readable(column, field, stored)
        if strict and readable is not None:
            told = F.concat(F.lit(f"{table}.{field.name}: cannot read '"), column, F.lit("'"))
            value = F.when(column.isNull() | readable.isNotNull(), value).otherwise(F.raise_error(told))
        columns.append(value.alias(field.name))
    return df.select(columns)


def rejects(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(role, column, text, count): the texts that ``conform`` cannot read, for the frames of some roles.

    Frames that serve several roles are read and listed once for each contract, under the first role.
    """
    seen: set[tuple[int, str]] = set()
    found = []
    for role, df in frames.items():
        table = ROLE_CONTRACTS[role]
        if (id(df), table) in seen:
            continue
        seen.add((id(df), table))
        tests = [(field.name, column, _readable(column, field, stored)) for field, column, stored in _matches(df, table)]
        entries = [
            F.when(column.isNotNull() & readable.isNull(), F.struct(F.lit(role).alias("role"), F.lit(name).alias("column"), column.alias("text")))
            for name, column, readable in tests
            if readable is not None
        ]
        if entries:
            found.append(df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*"))
    if not found:
        spark = next(iter(frames.values())).sparkSession
        return spark.createDataFrame([], "role string, column string, text string, count bigint")
    return reduce(DataFrame.unionByName, found).groupBy("role", "column", "text").count()


@dataclass(frozen=True)
class ReconInputs:
    """The inputs of a reconciliation, each conforming to its contract.

    One DataFrame may serve several roles; prior periods that share a table
    are then read in one pass.
    """

    booking_customers: DataFrame
    booking_lines: DataFrame
    booking_history_prev1: DataFrame
    booking_history_prev2: DataFrame
    booking_ledger: DataFrame
    loss_customers: DataFrame
    loss_lines: DataFrame
    loss_history: DataFrame
    loss_ledger: DataFrame
    audit_refs: DataFrame


# Which contract each role follows.
ROLE_CONTRACTS = {
    "booking_customers": "booking_customers",
    "booking_lines": "booking_lines",
    "booking_history_prev1": "booking_history",
    "booking_history_prev2": "booking_history",
    "booking_ledger": "movement_ledger",
    "loss_customers": "loss_customers",
    "loss_lines": "loss_lines",
    "loss_history": "loss_history",
    "loss_ledger": "movement_ledger",
    "audit_refs": "audit_refs",
}
