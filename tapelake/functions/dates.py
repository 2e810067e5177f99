"""Dates as published: ISO text and day-month-year stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

_LONG = tuple(m for m in MONTHS if m not in ("FEB", "APR", "JUN", "SEP", "NOV"))
_NOT_FEB = tuple(m for m in MONTHS if m != "FEB")
_YEAR = "(?!0000)[0-9]{4}"
_LEAP = "(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:0[48]|[2468][048]|[13579][26])00)"


def _any(names) -> str:
    return "(?:" + "|".join("".join(f"[{a}{a.lower()}]" for a in n) for n in names) + ")"


def stamp_pattern() -> str:
    """Regex of a real DD-Mon-YYYY date, month in any letter case."""
    return (
        f"(?:(?:0[1-9]|1[0-9]|2[0-8])-{_any(MONTHS)}-{_YEAR}|(?:29|30)-{_any(_NOT_FEB)}-{_YEAR}"
        f"|31-{_any(_LONG)}-{_YEAR}|29-{_any(('FEB',))}-{_LEAP})"
    )


def short_stamp_pattern() -> str:
    """Regex of DD-Mon-YY whose day exists in that month."""
    leap = "(?:[02468][048]|[13579][26])"
    return (
        f"(?:(?:0[1-9]|1[0-9]|2[0-8])-{_any(MONTHS)}-[0-9]{{2}}|(?:29|30)-{_any(_NOT_FEB)}-[0-9]{{2}}"
        f"|31-{_any(_LONG)}-[0-9]{{2}}|29-{_any(('FEB',))}-{leap})"
    )


def iso_pattern() -> str:
    """Regex of a real YYYY-MM-DD date."""
    return (
        f"(?:{_YEAR}-(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1[0-9]|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)|{_LEAP}-02-29)"
    )


def iso_day(c: Column) -> Column:
    """Date of strict ISO text, else null."""
    return F.when(c.rlike(rf"^{iso_pattern()}\z"), c.try_cast("date"))


def month_number(name: Column) -> Column:
    """1..12 of an English month abbreviation in any case, else null."""
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(name))
    return F.when(at > 0, at.cast("int"))


def legacy_stamp(raw: Column, expected: Column) -> Column:
    """struct(day date, failure string) of a legacy stamp.

    A four-digit year is the row's own date. A two-digit year is taken from `expected` (a date),
    and only if day and month agree with it; the century is never invented.
    """
    day = F.substring(raw, 1, 2)
    mon = month_number(F.substring(raw, 4, 3))
    agrees = (day.cast("int") == F.day(expected)) & (mon == F.month(expected))
    full, short = raw.rlike(rf"^{stamp_pattern()}\z"), raw.rlike(rf"^{short_stamp_pattern()}\z")
    own = F.make_date(F.substring(raw, 8, 4).cast("int"), mon, day.cast("int"))
    failure = (
        F.when(raw == "", "legacy_timestamp_blank")
        .when(full, None)
        .when(~short, "legacy_timestamp_unparseable")
        .when(~F.coalesce(agrees, F.lit(False)), "legacy_two_digit_year_unresolvable")
    )
    return F.struct(F.when(full, own).when(short & agrees, expected).alias("day"), failure.alias("failure"))
