"""Text normalisation as Columns. Source text is never repaired, only compared in a normal form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without leading and trailing whitespace of any kind (Spark's trim takes spaces only)."""
    return F.regexp_replace(c, _EDGES, "")


def norm(c: Column) -> Column:
    """Trimmed of whitespace and upper case; null stays null."""
    return F.upper(strip(c))


def is_blank(c: Column) -> Column:
    """Null, empty or whitespace only."""
    return c.isNull() | c.rlike(r"^\s*$")
