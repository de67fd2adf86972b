"""Periods of month numbers over tables that are partitioned by day.

``month(day) IN (..)`` says nothing about ranges of days, so it reaches neither row groups nor, where the day is not
itself the partition, partitions. A calendar lists the days of these months, and a semi-join with it lets Spark prune at run time: the
days' broadcast becomes a filter on the table's partitions before any file is read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.config import Period


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """(day, month, year) of all days from first to last."""
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    return days.select("day", F.month("day").alias("month"), F.year("day").alias("year"))


def days_of(days: DataFrame, period: Period) -> DataFrame:
    """The days of a calendar in a period."""
    if period.start is not None:
        days = days.where(F.col("day").between(F.lit(period.start), F.lit(period.end)))
    return days.where(F.col("month").isin(*period.months)) if period.months else days


def within_period(rows: DataFrame, day: str, period: Period, days: DataFrame) -> DataFrame:
    """The rows whose ``day`` is one of the calendar's days in a period.

    Days outside the calendar are dropped, so it must span the table's years. A calendar has 366 days a year, and hence is broadcast.
    """
    wanted = days_of(days, period).select(F.col("day").alias("calendar_day"))
    return rows.join(F.broadcast(wanted), F.col(day) == F.col("calendar_day"), "left_semi")
