"""Security codes (ISO 6166): check digit and validity, inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import norm


def check_digit(body: Column) -> Column:
    """Check digit of an 11-character body of A-Z0-9: letters become 10..35, then Luhn over all digits."""
    digits = F.array_join(F.transform(F.split(body, ""), lambda ch: F.conv(ch, 36, 10)), "")
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.when(k % 2 == 0, d.cast("int") * 2).otherwise(d.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda acc, x: acc + x - F.when(x > 9, 9).otherwise(0))
    return F.pmod(F.lit(10) - total % 10, F.lit(10))


def validity(isin: Column) -> Column:
    """First category that applies: BLANK, LEN, PREFIX, CHARSET, CHECKDIGIT, else VALID."""
    x = norm(isin)
    return (
        F.when(x.isNull() | (x == ""), "BLANK")
        .when(F.length(x) != 12, "LEN")
        .when(~x.startswith("IN"), "PREFIX")
        .when(~x.rlike(r"^IN[A-Z0-9]{9}[0-9]\z"), "CHARSET")
        .when(check_digit(F.substring(x, 1, 11)) != F.substring(x, 12, 1).cast("int"), "CHECKDIGIT")
        .otherwise("VALID")
    )


def _value(ch: Column) -> Column:
    """0..35 of one character of 0-9A-Z."""
    code = F.ascii(ch)
    return F.when(code >= 65, code - 55).otherwise(code - 48)


def luhn_is_valid(x: Column) -> Column:
    """Whether a 12-character code of A-Z0-9 starting with two letters has the right check digit.

    One fold from the right: a letter contributes two digits, hence the parity of a position
    depends on the letters right of it and is carried as the count of digits so far.
    """
    digits = F.transform(F.split(x, ""), _value)
    state = F.aggregate(
        F.reverse(digits),
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("at")),
        lambda s, v: F.struct(
            (
                s["total"]
                + F.when(v < 10, _luhn(v, s["at"])).otherwise(_luhn(v % 10, s["at"]) + _luhn(F.floor(v / 10).cast("int"), s["at"] + 1))
            ).cast("int").alias("total"),
            (s["at"] + F.when(v < 10, 1).otherwise(2)).cast("int").alias("at"),
        ),
    )
    return state["total"] % 10 == 0


def _luhn(d: Column, at: Column) -> Column:
    twice = d * 2
    return F.when(at % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)


def is_valid(isin: Column) -> Column:
    """True if valid, False if not blank and invalid, null if blank."""
    v = validity(isin)
    return F.when(v != "BLANK", v == "VALID")
