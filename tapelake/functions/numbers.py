"""Exact access to numbers that are kept as published text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII digits only; no plus sign, exponent, grouping or blanks.
DECIMAL_TEXT = r"-?[0-9]+(?:\.[0-9]+)?"
INTEGER_TEXT = r"-?[0-9]+"
#: Display grammar: optional sign, no leading zeros.
DISPLAY_TEXT = r"[+-]?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?"


def whole(pattern: str) -> str:
    """The pattern over the whole text; unlike `$`, `\\z` does not skip a final line end."""
    return rf"^(?:{pattern})\z"


def strict_decimal(c: Column, precision: int = 38, scale: int = 10) -> Column:
    """The value of decimal text, else null."""
    return F.when(c.rlike(whole(DECIMAL_TEXT)), c.try_cast(f"decimal({precision},{scale})"))


def strict_integer(c: Column) -> Column:
    """The value of integer text as bigint, else null (also beyond 64 bits)."""
    return F.when(c.rlike(whole(INTEGER_TEXT)), c.try_cast("bigint"))


def display_number(c: Column) -> Column:
    """The double a user interface shows, else null."""
    return F.when(c.rlike(whole(DISPLAY_TEXT)), c.try_cast("double"))
