"""Amounts: reading them from text and adding them up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CURRENCY_PREFIX_LENGTH = 3
_NUMBER = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:[+-]?inf(inity)?|nan))\s*$"
TOTAL_DIGITS = 13


def parse_amount(text: Column) -> Column:
    """Double from text such as ``-1,234.50``, ``NaN`` or ``Infinity``; NULL when it is no number."""
    digits = F.replace(text, F.lit(","), F.lit(""))
    return F.when(digits.rlike(_NUMBER), digits.try_cast("double"))


def parse_prefixed_amount(text: Column) -> Column:
    """Double from text such as ``USD 1,234.50``: drops the currency code."""
    return parse_amount(F.trim(F.substring(text, CURRENCY_PREFIX_LENGTH + 1, 2**31 - 1)))


BIN_BITS = 24
BIN_EXPONENTS = (48, 24, 0, -24, -48, -72, -96)
"""The powers of two that the bins of a total count."""

BOUND = 2.0**100
"""Amounts from this size on, infinite ones and NaN are added as they are, beside the bins."""

BINS = len(BIN_EXPONENTS) + 1


def split(amount: Column) -> list[Column]:
    """The amount as whole numbers of 2^48, 2^24, .. 2^-96, and what no bin can hold, each NULL or exact.

    Multiplying by a power of two, rounding to whole numbers and taking a rounded number's upper
    part away are all exact for doubles, so nothing above half of 2^-96 is lost.
    """
    fits = F.abs(amount) < BOUND
    digits = [F.rint(amount * (2.0**-exponent)) for exponent in BIN_EXPONENTS]
    lower = [digit - upper * (2.0**BIN_BITS) for upper, digit in zip(digits[:-1], digits[1:], strict=True)]
    return [F.when(fits, part.cast("bigint")) for part in (digits[0], *lower)] + [F.when(~fits, amount)]


def recombined(sums: Sequence[Column]) -> Column:
    """The double from the sums of all bins, rounded to 13 significant digits; NULL when nothing was added."""
    *bins, beside = sums
    parts = [part.cast("double") * (2.0**exponent) for part, exponent in zip(bins, BIN_EXPONENTS, strict=True)]
    inside = parts[0]
    for part in parts[1:]:
        inside = inside + part
    # Powers of ten up to 10^22 are exact, so the digits kept are those of the decimal number.
    shift = (TOTAL_DIGITS - 1) - F.floor(F.log10(F.abs(inside)))
    up, down = F.pow(F.lit(10.0), F.greatest(shift, F.lit(0))), F.pow(F.lit(10.0), F.greatest(-shift, F.lit(0)))
    rounded = F.when(inside == 0, 0.0).when(shift > 22, inside).when(shift >= 0, F.rint(inside * up) / up).otherwise(F.rint(inside / down) * down)
    return F.when(beside.isNull(), rounded).otherwise(F.coalesce(inside, F.lit(0.0)) + beside)


def total(amount: str) -> Column:
    """Sum of the double column ``amount``, bit-equal however its rows are ordered and partitioned.

    Each amount is split into bins of 24 bits that are added as integers, which no order changes and
    no cancelling of large amounts blurs; 2^38 rows of one group fill no bin. The finished total is rounded to
    13 significant digits, which takes away what decimal amounts lack as doubles. NaN and infinite amounts
    give NaN or infinite totals. NULL when there is nothing to add.
    """
    return recombined([F.sum(part) for part in split(F.expr(amount))])


def share_percent(part: Column, whole: Column) -> Column:
    """Size of ``part`` in percent of ``whole``, rounded half to even.

    0 when ``whole`` is 0, NULL when ``part`` is NULL.
    """
    ratio = F.abs(F.try_divide(part, whole)) * 100.0
    return F.rint(F.when(F.abs(whole) > 0, ratio).otherwise(0.0))


def within(value: Column, bounds: tuple[float, float]) -> Column:
    return value.between(*bounds)
