"""Period predicates that reach the Parquet scan."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermend.config import Period


def in_period(period: Period, day: str, month: str | None = None) -> Column:
    """Whether the date or timestamp column ``day`` falls in ``period``.

    The window is written half-open on the bare column: that is the inclusive
    window for dates, keeps the whole last day of a timestamp, and leaves
    nothing around the column that would stop it from being pushed down.
    ``month`` names a month-number column; without it the month comes from ``day``.
    """
    tests = []
    if period.start is not None:
        after = period.end + timedelta(days=1)
        tests.append(f"{day} >= DATE'{period.start}' AND {day} < DATE'{after}'")
    if period.months:
        numbers = ", ".join(map(str, period.months))
        tests.append(f"{month or f'month({day})'} IN ({numbers})")
    return F.expr(" AND ".join(tests))
