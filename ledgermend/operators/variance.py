"""Customers with CRM amounts and ledger movement side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.operators.idlists import KEY, of_known_customers


def spine(customers: DataFrame) -> DataFrame:
    """Distinct customers.

    Everything joined later depends on the customer alone, so removing repeats
    here, on two columns, equals removing them from the wide result. Customers
    without an id match nothing and never pass the movement filter; leaving
    them out also keeps them from piling up in one join partition.
    """
    names = F.collect_set(F.struct("name")).alias("names")
    # Grouped by the customer alone, so that one placement serves this and all joins.
    return (
        of_known_customers(customers).groupBy(KEY).agg(names).select(KEY, F.explode("names").alias("one")).select(KEY, "one.name")
    )


def with_variance(
    customers: DataFrame, crm: DataFrame, ledger: DataFrame, crm_usd: str, sign: str
) -> DataFrame:
    """Customers whose ledger movement or CRM amount has ``sign``, ``>`` or ``<``, with the gap.

    ``crm`` and ``ledger`` hold one row per customer. Amounts keep their NULLs
    next to the ``*_filled`` columns because the labels tell a missing amount
    from a zero.
    """
    joined = spine(customers).join(crm, KEY, "left").join(ledger, KEY, "left")
    return with_gap(joined, crm_usd).where(has_sign(sign))


def has_sign(sign: str) -> Column:
    """Whether the movement or the CRM amount of ``with_gap`` has a sign, ``>`` or ``<``."""
    return F.expr(f"arr_filled {sign} 0 OR crm_filled {sign} 0")


def with_gap(joined: DataFrame, crm_usd: str) -> DataFrame:
    """Amounts with 0 for NULL, their gap and its size."""
    filled = joined.selectExpr("*", "coalesce(arr_usd, 0D) AS arr_filled", f"coalesce({crm_usd}, 0D) AS crm_filled")
    return filled.selectExpr("*", "arr_filled - crm_filled AS diff", "abs(arr_filled - crm_filled) AS abs_diff")


def both_spines(booking_customers: DataFrame, loss_customers: DataFrame) -> DataFrame:
    """Each customer of either branch once, with the different names that each branch has (``b_names``, ``c_names``)."""
    name, none = F.struct("name"), F.lit(None).cast("struct<name:string>")
    if booking_customers is loss_customers:
        tagged = of_known_customers(booking_customers).select(KEY, name.alias("b"), name.alias("c"))
    else:
        tagged = of_known_customers(booking_customers).select(KEY, name.alias("b"), none.alias("c"))
        tagged = tagged.unionByName(of_known_customers(loss_customers).select(KEY, none.alias("b"), name.alias("c")))
    return tagged.groupBy(KEY).agg(F.collect_set("b").alias("b_names"), F.collect_set("c").alias("c_names"))
