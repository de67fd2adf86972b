"""Drivers of a variance: which ledger category belongs to which driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.functions.rules import first_match


def driver_of(category: Column, drivers: Mapping[str, tuple[str, ...]]) -> Column:
    """Name of the driver a ledger category belongs to, NULL if to none."""
    return first_match(
        ((category.isin(*categories), F.lit(name)) for name, categories in drivers.items()),
        F.lit(None).cast("string"),
    )


BROADCAST_CATEGORIES = 100_000
"""Up to so many categories are broadcast; a larger mapping is joined by a shuffle."""


def mapping_of(table: DataFrame) -> DataFrame:
    """(category, driver) of a mapping table, each category once; categories named twice, or without a driver, are refused.

    Rows without a category can match nothing and are left out.
    """
    mapping = table.select(F.col("category").cast("string").alias("category"), F.col("driver").cast("string").alias("driver"))
    mapping = mapping.where("category IS NOT NULL")
    wrong = mapping.groupBy("category").agg(F.count("*").alias("times"), F.min("driver").alias("driver"))
    wrong = [row.category for row in wrong.where("times > 1 OR driver IS NULL").orderBy("category").limit(5).collect()]
    if wrong:
        raise ValueError(f"mapping: categories named twice or without a driver, such as {', '.join(map(repr, wrong))}")
    return mapping


def with_driver(rows: DataFrame, mapping: DataFrame, name: str = "driver", category: str = "bridge_account") -> DataFrame:
    """``rows`` with the driver of each row's category, NULL if it has none, by a mapping from ``mapping_of``.

    The mapping is broadcast up to BROADCAST_CATEGORIES rows, which are counted first.
    """
    small = mapping.limit(BROADCAST_CATEGORIES + 1).count() <= BROADCAST_CATEGORIES
    side = mapping.select(F.col("category").alias(f"{name}_category"), F.col("driver").alias(name))
    joined = rows.join(F.broadcast(side) if small else side, F.col(category) == F.col(f"{name}_category"), "left")
    return joined.drop(f"{name}_category")
