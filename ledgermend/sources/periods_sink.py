"""The report by period: a rerun of a quarter replaces only that quarter, and only after its rows were counted."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.sources.workspace import delete, new_path, written

PERIOD = "period"


class RowCountError(ValueError):
    """A period's rows are not what they should be; what the table had stays."""


@contextmanager
def computed_once(report: DataFrame) -> Iterator[DataFrame]:
    """The report from a table of its own, for several calls of ``write_period``, each of which would compute it anew."""
    spark = report.sparkSession
    path = new_path(spark, "report-once")
    try:
        yield written(_without_odd_names(report), path)
    finally:
        delete(spark, path)


def write_period(report: DataFrame, path: str, period: str, least: int = 1, most_change: float | None = None) -> int:
    """Replaces the partition of ``period`` in the Parquet table at ``path`` by the rows of ``report``; returns their number.

    The report is computed once, into a table of its own, and counted there. Fewer rows than ``least``, or, with
    ``most_change``, a count that differs from the period's present one by more than that share, raise RowCountError and leave the table as it is.
    Other periods are not touched; a call that is repeated leaves an equal table.
    """
    spark = report.sparkSession
    staged = new_path(spark, "report")
    try:
        rows = written(_without_odd_names(report), staged)
        count = rows.count()
        if count < least:
            raise RowCountError(f"period {period}: {count} rows, at least {least} expected")
        had = present_rows(spark, path, period)
        if most_change is not None and had and abs(count - had) > most_change * had:
            raise RowCountError(f"period {period}: {count} rows instead of {had}, more than {most_change:.0%} apart")
        placed = rows.withColumn(PERIOD, F.lit(period))
        placed.write.partitionBy(PERIOD).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    finally:
        delete(spark, staged)
    return count


def present_rows(spark: SparkSession, path: str, period: str) -> int:
    """The rows that the table has for a period; 0 without table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return 0
    return spark.read.option("recursiveFileLookup", "false").schema(f"{PERIOD} string").parquet(path).where(F.col(PERIOD) == period).count()


def read_periods(spark: SparkSession, path: str, *periods: str) -> DataFrame:
    """The rows of some periods, or of all, with their period; other periods' files are not read."""
    table = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    table = table.withColumn(PERIOD, F.col(PERIOD).cast("string"))
    return table.where(F.col(PERIOD).isin(*periods)) if periods else table


def _without_odd_names(report: DataFrame) -> DataFrame:
    """The report with the blanks around its headers removed, where that leaves them different."""
    names = [name.strip() for name in report.columns]
    return report.toDF(*names) if len(set(names)) == len(names) else report
