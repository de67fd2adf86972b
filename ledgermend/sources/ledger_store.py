"""An incremental store of ledger sums: a new snapshot day reads only itself.

The store holds one row per customer, row type, day, category and sign, with the amounts in the bins of
``functions.money``. Bins add up exactly in any order, so sums of days equal sums of the ledger's rows bit by bit, and any
period, driver map or monthly window is a merge of the days in it. Days are partitions: a day that is added again
replaces itself, and a query reads the days of its windows only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermend.config import Period, ReconConfig
from ledgermend.operators.idlists import KEY
from ledgermend.operators.rollups import LEDGER_PARTS, ledger_rows, ledger_totals, with_driver_names

DAY = "snapshot_date"
_GROUP = (KEY, "row_type", DAY, "bridge_account", "loss")
_PARTS = [name for side in LEDGER_PARTS.values() for name in side]
_BESIDE = {side[-1] for side in LEDGER_PARTS.values()}

SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("row_type", T.StringType()), T.StructField("bridge_account", T.StringType()), T.StructField("loss", T.BooleanType())]
    + [T.StructField(name, T.DoubleType() if name in _BESIDE else T.LongType()) for name in _PARTS]
    + [T.StructField(DAY, T.DateType())]
)


def day_sums(ledger: DataFrame) -> DataFrame:
    """The sums of ledger rows that the store holds; rows without a day can be in no period and are left out.

    Tasks take the rows by ranges of day and customer, which serve the sums too, so one shuffle does. A task then writes few
    days, a large day is shared by several tasks, and the days' files are at most as many as days and tasks, not days times tasks.
    """
    dated = ledger.withColumn(DAY, F.col(DAY).cast("date")).where(f"{DAY} IS NOT NULL")
    rows = ledger_rows(dated.repartitionByRange(DAY, KEY))
    return rows.groupBy(*_GROUP).agg(*(F.sum(name).alias(name) for name in _PARTS)).select(*SCHEMA.names)


@dataclass(frozen=True)
class LedgerStore:
    """Sums of a ledger by day at a path."""

    spark: SparkSession
    path: str

    def add_days(self, ledger: DataFrame) -> None:
        """Adds all days of ``ledger``, which must be whole: a day that the store has already is replaced.

        Only these rows are read. A call that is repeated leaves an equal store.
        """
        sums = day_sums(ledger)
        sums.write.partitionBy(DAY).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def rows(self) -> DataFrame:
        """The sums of all days, in the form of ``ledger_rows``."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def days(self) -> DataFrame:
        return self.rows().select(DAY).distinct()

    def rollup(self, config: ReconConfig, drivers: Mapping[str, tuple[str, ...]], monthly: Period | None = None) -> DataFrame:
        """What ``ledger_rollup`` gives for the whole ledger, from the days of the windows."""
        return with_driver_names(ledger_totals(self.rows(), config, [drivers], monthly), drivers)
