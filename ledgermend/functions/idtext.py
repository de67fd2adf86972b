"""Text form of one identifier inside an identifier list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a missing element, and a list without rows, is printed.
NULL_TEXT = "NULL"
SEPARATOR = ","

_NEEDS_QUOTES = r'[\s,{}"\\]'
_TO_ESCAPE = r'(["\\])'


def element_text(name: str) -> Column:
    """The identifier in column ``name`` as a list element.

    Quoted where its text would be ambiguous, and without braces.
    """
    identifier = F.col(name)
    ambiguous = (
        (identifier == "") | (F.upper(identifier) == NULL_TEXT) | identifier.rlike(_NEEDS_QUOTES)
    )
    escaped = F.regexp_replace(name, _TO_ESCAPE, r"\\$1")
    quoted = F.concat(F.lit('"'), F.translate(escaped, "{}", ""), F.lit('"'))
    return F.when(ambiguous, quoted).otherwise(F.coalesce(identifier, F.lit(NULL_TEXT)))


def repeated(element: Column, times: Column) -> Column:
    """``times`` copies of a list element."""
    return F.concat(
        F.repeat(F.concat(element, F.lit(SEPARATOR)), (times - 1).cast("int")), element
    )
