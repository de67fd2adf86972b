"""Ordered rules as one conditional expression."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, Column | str]], otherwise: Column) -> Column:
    """Label of the first rule whose condition is true, else ``otherwise``."""
    (condition, label), *rest = rules
    chain = reduce(lambda done, rule: done.when(*rule), rest, F.when(condition, label))
    return chain.otherwise(otherwise)


def largest_of(candidates: Iterable[tuple[Column, str]]) -> Column:
    """Label of the largest value; on a tie the candidate named first wins."""
    candidates = list(candidates)
    top = F.greatest(*(value for value, _ in candidates))
    return first_match(
        ((value == top, label) for value, label in candidates), F.lit(None).cast("string")
    )
