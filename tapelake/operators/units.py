"""Quantities in different units and writings, converted to common units.

Numbers and unit expressions are read by a small grammar; a unit is an exponent vector over the
base dimensions (rupee, share) with a scale and an offset to the canonical unit. The unit is the
one in the value's own text, else the one the sender's note states for the field, else the
field's default. A traded value without any statement takes the scale of rupees that brings
value / (shares x close price) nearest to 1.

Numbers are exact: whole part and fraction are multiplied apart, so nothing is rounded before the
one rounding to a whole paisa or share at the end, half a unit away from zero.

Nulls and odd texts: blank or non-numeric text, a number beyond 18 integer digits, a unit of the
wrong dimension and lots without a lot size have no common value and are no case. Decimals beyond
the 20th are rounded. Repeated rows each count. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import broadcast_if_small, fixed


@dataclass(frozen=True)
class Unit:
    """canonical = value * scale + offset, in the base units of the exponent vector `dims` (rupee, share)."""

    dims: tuple[int, int]
    scale: int = 1
    offset: int = 0
    per_lot: bool = False

    def __mul__(self, factor: int) -> Unit:
        return Unit(self.dims, self.scale * factor, self.offset, self.per_lot)


MONEY, SHARES = (1, 0), (0, 1)
# Scale words.
SCALES = {
    "k": 1_000, "thousand": 1_000, "thousands": 1_000, "'000": 1_000, "000s": 1_000, "l": 100_000, "lac": 100_000, "lacs": 100_000, "lakh": 100_000, "lakhs": 100_000,
    "m": 1_000_000, "mn": 1_000_000, "mio": 1_000_000, "million": 1_000_000, "millions": 1_000_000, "cr": 10_000_000, "crs": 10_000_000, "crore": 10_000_000,
    "crores": 10_000_000, "hundred": 100, "hundreds": 100, "bn": 1_000_000_000, "billion": 1_000_000_000, "billions": 1_000_000_000,
}
# Unit nouns. Money is canonical in paise, quantities in shares.
NOUNS = {
    **dict.fromkeys(("rupee", "rupees", "rs", "inr", "₹", "/-"), Unit(MONEY, 100)),
    **dict.fromkeys(("paise", "paisa"), Unit(MONEY, 1)),
    **dict.fromkeys(("share", "shares", "nos", "no", "units", "unit"), Unit(SHARES, 1)),
    **dict.fromkeys(("lot", "lots"), Unit(SHARES, 1, per_lot=True)),
}
#: Scales tried when nothing states the unit of a traded value: rupees, thousands, lakhs, crores.
GUESSES = (1, 1_000, 100_000, 10_000_000)

_words = lambda names: "|".join(sorted(("\\Q" + n + "\\E" for n in names), key=len, reverse=True))
_SCALE, _NOUN = _words(SCALES), _words(NOUNS)
_CURRENCY = "rs\\.?|inr|₹"
_NUMBER = r"-?(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{2,3})+)(?:\.[0-9]+)?(?:e[+-]?[0-9]{1,3})?"
#: [currency] number [scale][.] [of] [noun][.]
VALUE = rf"^({_CURRENCY})?\s*({_NUMBER})\s*({_SCALE})?\.?\s*(?:of\s+)?({_NOUN})?\.?\z"
PLAIN = r"^[0-9]+(?:\.[0-9]+)?\z"

_MENTION = {"money": "turnover|traded values?|values?|tottrdval", "shares": "traded quantit(?:y|ies)|volumes?|quantit(?:y|ies)|qty|tottrdqty"}
#: 18 integer digits and 20 decimals: a crore value keeps its paise, and 13 decimals more.
_NUM = "decimal(38,20)"


def _lookup(word: Column, table: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[word]


def _unit(scale: Column, noun: Column, dims: tuple[int, int]) -> Column:
    """struct(stated, fits, factor, lots) of a scale word and a noun ('' where absent), for a field of `dims`."""
    default = 100 if dims == MONEY else 1
    factor = F.coalesce(_lookup(scale, SCALES), F.lit(1)) * F.coalesce(_lookup(noun, {n: u.scale for n, u in NOUNS.items()}), F.lit(default))
    wrong = [n for n, u in NOUNS.items() if u.dims != dims]
    return F.struct(
        ((scale != "") | (noun != "")).alias("stated"),
        (~noun.isin(wrong)).alias("fits"),
        factor.cast("bigint").alias("factor"),
        noun.isin([n for n, u in NOUNS.items() if u.per_lot]).alias("lots"),
    )


def read_value(text: Column, dims: tuple[int, int]) -> Column:
    """struct(number, unit) of one published text; number null where it is not numeric."""
    plain = F.coalesce(text.rlike(PLAIN), F.lit(False))
    low = F.lower(strip(text))
    part = lambda i: F.regexp_extract(low, VALUE, i)
    number = F.when(plain, text.try_cast(_NUM)).when(low.rlike(VALUE), F.replace(part(2), F.lit(","), F.lit("")).try_cast(_NUM))
    noun = F.when(part(4) != "", part(4)).otherwise(F.replace(part(1), F.lit("."), F.lit("")))
    empty = F.lit("")
    unit = _unit(F.when(plain, empty).otherwise(part(3)), F.when(plain, empty).otherwise(noun), dims)
    return F.struct(plain.alias("plain"), number.alias("number"), unit.alias("unit"))


def read_note(note: Column, dims: tuple[int, int]) -> Column:
    """The unit struct that a sender's note states for a field; `stated` false where it states none.

    A statement follows a mention of the field, up to a mention of the other field or a semicolon;
    a note without any mention states units by their own dimension.
    """
    mine, other = ("money", "shares") if dims == MONEY else ("shares", "money")
    low = F.lower(F.coalesce(note, F.lit("")))
    after = F.regexp_extract(low, rf"(?<![a-z])(?:{_MENTION[mine]})(?![a-z])([^;]*?)(?=(?<![a-z])(?:{_MENTION[other]})(?![a-z])|;|\z)", 1)
    nouns = _words(n for n, u in NOUNS.items() if u.dims == dims and n not in ("no", "/-", "unit", "units"))
    alone = F.regexp_extract(low, rf"([^;,/:]*(?<![a-z])(?:{nouns})(?![a-z])[^;,/:]*)", 1)
    mentioned = low.rlike(rf"(?<![a-z])(?:{_MENTION['money']}|{_MENTION['shares']})(?![a-z])")
    part = F.when(mentioned, after).otherwise(alone)
    word = lambda ws: F.regexp_extract(part, rf"(?<![a-z0-9'])({ws})(?![a-z0-9])", 1)
    return _unit(word(_SCALE), word(nouns), dims)


def _in_force(own: Column, note: Column) -> Column:
    """The unit of the value's own text, else the note's, else null."""
    return F.when(own["stated"], own).when(note["stated"], note)


def _factor(unit: Column, lot: Column) -> Column:
    """Canonical units per published unit, null where the unit does not fit the field or its lot is unknown."""
    size = F.when(unit["lots"], lot.try_cast("decimal(9,0)")).otherwise(F.lit(1).cast("decimal(9,0)"))
    return F.when(unit["fits"], unit["factor"].cast("decimal(12,0)") * size).try_cast("decimal(12,0)")


def _times(number: Column, factor: Column) -> Column:
    """number * factor as bigint, rounded once. Both partial products fit 38 digits with all their decimals."""
    size = F.abs(number)
    total = F.floor(size) * factor + F.round((size % F.lit(1).cast("decimal(1,0)")).cast("decimal(20,20)") * factor, 0)
    return F.when(number < 0, -total).otherwise(total).try_cast("bigint")


def _nearest(ratio: Column) -> Column:
    """The guess g that brings ratio * g nearest to 1 in ratio; of a tie the smaller. Null for null."""
    bounds = [(a * b) ** -0.5 for a, b in zip(GUESSES, GUESSES[1:])]
    out = F.when(ratio >= bounds[0], GUESSES[0])
    for low, g in zip(bounds[1:], GUESSES[1:]):
        out = out.when(ratio >= low, g)
    return out.when(ratio.isNotNull(), GUESSES[-1])


def common_units(rows: DataFrame, members: DataFrame) -> DataFrame:
    """row_id, shares, paise (bigint, null where there is none), qty_case, val_case."""
    notes = members.groupBy("member_id").agg(F.max("units_note").alias("note"))
    notes = notes.select("member_id", read_note(F.col("note"), SHARES).alias("qty_note"), read_note(F.col("note"), MONEY).alias("val_note")).where("qty_note.stated or val_note.stated")
    df = rows.select("row_id", "member_id", "tottrdqty", "tottrdval", "price_close", "new_brd_lot_qty").join(broadcast_if_small(notes), "member_id", "left")
    df = fixed(df, q=read_value(F.col("tottrdqty"), SHARES), v=read_value(F.col("tottrdval"), MONEY))
    lot, one = F.col("new_brd_lot_qty"), F.lit(1).cast("decimal(12,0)")
    df = fixed(df, qu=_in_force(F.col("q.unit"), F.col("qty_note")), vu=_in_force(F.col("v.unit"), F.col("val_note")))
    q_factor = F.when(F.col("qu").isNull(), one).otherwise(_factor(F.col("qu"), lot))
    df = fixed(df, q_factor=q_factor)
    expected = F.col("q.number").cast("double") * F.col("q_factor").cast("double") * F.col("price_close").try_cast("double")
    ratio = F.when((F.col("v.number") > 0) & (expected > 0), F.col("v.number").cast("double") / expected)
    guess = F.when(F.col("vu").isNull() & F.col("v.number").isNotNull(), 100 * F.coalesce(_nearest(ratio), F.lit(1)))
    df = fixed(df, v_factor=F.when(F.col("vu").isNull(), guess.cast("decimal(12,0)")).otherwise(_factor(F.col("vu"), lot)))
    df = df.select(
        "row_id",
        _times(F.col("q.number"), F.col("q_factor")).alias("shares"),
        _times(F.col("v.number"), F.col("v_factor")).alias("paise"),
        (~F.col("q.plain") | F.coalesce(F.col("qu.lots") | (F.col("qu.factor") != 1), F.lit(False))).alias("q_odd"),
        (~F.col("v.plain") | (F.col("v_factor") != 100)).alias("v_odd"),
    )
    case = lambda x, odd: (F.col(x).isNotNull() & F.col(odd)).alias
    return df.select("row_id", "shares", "paise", case("shares", "q_odd")("qty_case"), case("paise", "v_odd")("val_case"))


def converted(rows: DataFrame, members: DataFrame) -> DataFrame:
    """row_id, field_name, common_value of every numeric value that was not plain shares or rupees."""
    found = F.filter(
        F.array(
            F.when(F.col("qty_case"), F.struct(F.lit("tottrdqty").alias("field_name"), F.col("shares").alias("common_value"))),
            F.when(F.col("val_case"), F.struct(F.lit("tottrdval").alias("field_name"), F.col("paise").alias("common_value"))),
        ),
        lambda x: x.isNotNull(),
    )
    return common_units(rows, members).where("qty_case or val_case").select("row_id", F.explode(found).alias("x")).select("row_id", "x.*")
