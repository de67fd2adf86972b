"""Identifier lists per customer, as text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.functions.idtext import SEPARATOR, element_text, repeated

KEY = "customer_id"


def of_known_customers(df: DataFrame) -> DataFrame:
    """Rows that can meet a customer in a join.

    Id lists need this said outright: the join's own NULL test cannot move below
    the numbering of pieces, and rows without a customer would form one list.
    """
    return df.where("customer_id IS NOT NULL")


@dataclass(frozen=True)
class IdList:
    """The ids in ``column`` of ``source`` as the list ``name``; NULLs and, unless ``distinct``, repeats stay."""

    name: str
    source: DataFrame
    column: str
    distinct: bool = False


def id_lists(lists: Sequence[IdList]) -> DataFrame:
    """One row per customer with all lists in text form, NULL for a list without rows.

    Ids are sorted, NULLs last. Lists of the same DataFrame come from one pass over it, and all
    lists share the same three exchanges.

    A customer may own any share of the rows, so no task ever gathers or sorts
    one customer's ids. Equal ids are counted first, which spreads a large
    customer over all tasks by id. A range partitioning by customer and id then
    cuts every large list into consecutive pieces, each turned into text where
    it lies. Only finished pieces, at most one per partition, meet in the end;
    they are as large as the cell they form.
    """
    counted = counted_ids(lists)
    element = element_text("id")
    once = listed_once(lists)
    pieces = (
        counted.repartitionByRange(KEY, "list", F.col("id").asc_nulls_last())
        .select(
            KEY,
            "list",
            "id",
            F.spark_partition_id().alias("piece"),
            F.when(once, element).otherwise(repeated(element, F.col("copies"))).alias("element"),
        )
        .groupBy(KEY, "list", "piece")
        .agg(_joined("element", "id").alias("text"))
    )
    return pieces.groupBy(KEY).agg(
        *(
            _joined(f"CASE WHEN list = {number} THEN text END", "piece").alias(one.name)
            for number, one in enumerate(lists)
        )
    )


def counted_ids(lists: Sequence[IdList]) -> DataFrame:
    """(customer_id, list, id, copies): each id of each list once."""
    by_source: dict[int, list[tuple[int, IdList]]] = {}
    for number, one in enumerate(lists):
        by_source.setdefault(id(one.source), []).append((number, one))
    stacked = reduce(DataFrame.unionByName, map(_entries, by_source.values()))
    return stacked.groupBy(KEY, "list", "id").agg(F.expr("count(1)").alias("copies"))


def listed_once(lists: Sequence[IdList]) -> Column:
    """Whether a list shows each id once."""
    return F.col("list").isin([number for number, one in enumerate(lists) if one.distinct])


def _entries(own: list[tuple[int, IdList]]) -> DataFrame:
    """The ids of all lists of one source, each with the number of its list."""
    ids = [
        F.struct(F.lit(number).alias("list"), F.col(one.column).cast("string").alias("id"))
        for number, one in own
    ]
    return own[0][1].source.select(KEY, F.explode(F.array(*ids)).alias("entry")).select(KEY, "entry.*")


def with_lists(df: DataFrame, lists: Sequence[IdList]) -> DataFrame:
    """``df`` with the lists of each row's customer; the lists, the widest columns, come last."""
    return df.join(id_lists(lists), KEY, "left")


def _joined(text: str, order: str) -> Column:
    return F.expr(
        f"listagg({text}, '{SEPARATOR}') WITHIN GROUP (ORDER BY {order} ASC NULLS LAST)"
    )
