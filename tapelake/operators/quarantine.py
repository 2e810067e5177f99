"""Lines that fail their layout, apart from the rows that load.

One anchored regex per layout decides a whole line in one pass; it is generated from the field
list, including real calendar dates. Only lines that do not match go on, to incremental field
prefixes: each pattern is one field longer than the one before, and the first that fails names
the broken field and with it the reason. The prefixes run once a reason, in the published order:
fields of any content (syntax, then width), then the date field, then the numeric fields.

Nulls: a null line has no characters and counts as `empty_interior_line`. A line whose member is
unknown, or whose layout or width is null, is measured against any width its layout allows, and
without a layout it is a `row_fieldcount_mismatch`. A two-digit year without file date is
unresolvable. Texts of any length are matched with possessive repeats, so the matcher's stack does
not grow. Repeated lines are judged one by one. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_pattern, legacy_stamp, short_stamp_pattern, stamp_pattern
from ..functions.numbers import DECIMAL_TEXT, INTEGER_TEXT
from ..schema import FIELD_MAP, LAYOUTS, LEGACY, UDIFF
from ..session import broadcast_if_small, fixed

#: One field of any content: quoted (two quotes are one), or plain (a quote inside is text), or empty.
FIELD = r'(?:"(?:[^"]++|"")*+"|[^",][^,]*+|)'
_KINDS = {
    "decimal": f"(?:{DECIMAL_TEXT})?",
    "integer": f"(?:{INTEGER_TEXT})?",
    "iso": iso_pattern(),
    "stamp": stamp_pattern(),
    "any stamp": f"(?:{stamp_pattern()}|{short_stamp_pattern()})",
}
_END = r"(?:,|\z)"
#: Whole fields from the start of a line, each with its comma.
HEAD = rf"^(?:{FIELD},)*+"


def field_pattern(kind: str) -> str:
    """Pattern of one field, plain or quoted."""
    return FIELD if kind == "text" else rf'(?:{_KINDS[kind]}|"{_KINDS[kind]}")'


def row_pattern(layout, extra_empty: bool = False) -> str:
    """The anchored whole-row regex of a layout; `extra_empty` adds one field that must be empty."""
    return "^" + ",".join(field_pattern(k) for _, k in layout) + (r',(?:"")?' if extra_empty else "") + r"\z"


def prefix_patterns(layout, kinds: dict[str, str]) -> list[tuple[str, str]]:
    """(field, pattern) of each field whose kind is in `kinds`: the prefix up to it, such fields typed by `kinds`, all others of any content."""
    out, parts = [], []
    for name, kind in layout:
        parts.append(field_pattern(kinds.get(kind, "text")))
        if kind in kinds:
            out.append((name, "^" + ",".join(parts) + _END))
    return out


def first_broken(line: Column, patterns: list[tuple[str, str]], reason: str) -> Column:
    """struct(reason, field) of the first prefix that the line does not match, null if it matches all."""
    none = F.lit(None).cast("struct<reason:string,field:string>")
    return reduce(lambda rest, p: F.when(~line.rlike(p[1]), _broken(reason, F.lit(p[0]))).otherwise(rest), reversed(patterns), none)


def _broken(reason: str | Column, field: Column) -> Column:
    return F.struct((F.lit(reason) if isinstance(reason, str) else reason).alias("reason"), field.alias("field"))


def unquote(field: Column) -> Column:
    """The value of one matched field."""
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), inner).otherwise(field)


def nth_field(line: Column, n: int) -> Column:
    """Value of the n-th field (from 0) of a well-formed line."""
    return unquote(F.regexp_extract(line, rf"^(?:{FIELD},){{{n}}}({FIELD}){_END}", 1))


def fields(line: Column) -> Column:
    """All values of a well-formed line."""
    return F.transform(F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(rf"({FIELD}),"), F.lit(1)), unquote)


def judge(lines: DataFrame, members: DataFrame) -> DataFrame:
    """The lines with `reason`, `width` (null unless well-formed, or the line loads) and `broken_field`; reason null: the line loads.

    The broken field of a syntax error is the one that does not end as it should, of a wrong width
    the first that is missing; a field beyond the layout has no name.
    """
    narrow = members.select("member_id", F.col("detected_format").alias("_format"), F.col("header_width").alias("_width"), F.col("date_from_filename").alias("_day"))
    narrow = narrow.groupBy("member_id").agg(*[F.min(c).alias(c) for c in ("_format", "_width", "_day")])
    own = ("_format", "_width", "_day", "reason", "width", "broken_field", "_line", "_ok", "_head", "_rest", "_fields", "_broken")
    df = lines.select(*[c for c in lines.columns if c not in own], F.coalesce("raw_line", F.lit("")).alias("_line")).join(broadcast_if_small(narrow), "member_id", "left")
    line, legacy, modern = F.col("_line"), F.col("_format") == "legacy13", F.col("_format") == "udiff34"
    may = lambda w: F.col("_width").isNull() | (F.col("_width") == w)
    ok = (
        F.when(legacy, (may(13) & line.rlike(row_pattern(LEGACY))) | (may(14) & line.rlike(row_pattern(LEGACY, True))))
        .when(modern, may(34) & line.rlike(row_pattern(UDIFF)))
        .otherwise(False)
    )
    df = df.withColumn("_ok", F.coalesce(ok, F.lit(False)))

    # Fields of any content: how far the line goes on being well-formed, and what follows.
    unclear = lambda c: F.when(~F.col("_ok"), c)
    df = df.withColumn("_head", unclear(F.regexp_extract(line, HEAD, 0)))
    df = df.withColumns({"_rest": F.substring(line, F.length("_head") + 1, F.length(line)), "_fields": F.size(F.regexp_extract_all(F.col("_head"), F.lit(rf"({FIELD}),"), F.lit(1)))})
    name_at = lambda i: F.when(legacy, F.get(F.array(*[F.lit(n) for n, _ in LEGACY]), i)).when(modern, F.get(F.array(*[F.lit(n) for n, _ in UDIFF]), i))
    well_formed, width = F.col("_rest").rlike(rf"^{FIELD}\z"), F.col("_fields") + 1
    fits = F.when(legacy, (may(13) & (width == 13)) | (may(14) & (width == 14) & F.col("_rest").isin("", '""'))).when(modern, may(34) & (width == 34)).otherwise(False)
    # The date field, then the numbers.
    not_blank, any_stamp = ((("TIMESTAMP", "^" + ",".join([FIELD] * 10 + [p]) + _END)) for p in (r'(?!"?"?(?:,|\z))' + FIELD, field_pattern("any stamp")))
    short = F.regexp_extract(line, "^" + ",".join([FIELD] * 10 + [f'"?({short_stamp_pattern()})"?']) + _END, 1)
    unresolved = F.when(legacy_stamp(short, F.col("_day"))["failure"] == "legacy_two_digit_year_unresolvable", _broken("legacy_two_digit_year_unresolvable", F.lit("TIMESTAMP")))
    numbers = {"decimal": "decimal", "integer": "integer"}
    broken = (
        F.when(line == "", _broken("empty_interior_line", F.lit(None).cast("string")))
        .when(~well_formed, _broken("csv_syntax_error", name_at(F.col("_fields"))))
        .when(~F.coalesce(fits, F.lit(False)), _broken("row_fieldcount_mismatch", name_at(width)))
        .when(legacy, F.coalesce(
            first_broken(line, [not_blank], "legacy_timestamp_blank"), first_broken(line, [any_stamp], "legacy_timestamp_unparseable"), unresolved,
            first_broken(line, prefix_patterns(LEGACY, numbers), "numeric_field_unparseable"),
        ))
        .otherwise(F.coalesce(first_broken(line, prefix_patterns(UDIFF, {"iso": "iso"}), "udiff_traddt_unparseable"), first_broken(line, prefix_patterns(UDIFF, numbers), "numeric_field_unparseable")))
    )
    df = fixed(df, _broken=unclear(broken))
    # A legacy line with a short stamp fails the whole-row regex and loads all the same if its day agrees with the file.
    reason = F.col("_broken.reason")
    whole = reason.isNull() | reason.isin("empty_interior_line", "csv_syntax_error")
    return df.select("*", reason.alias("reason"), F.when(~whole, width).alias("width"), F.col("_broken.field").alias("broken_field")).drop("_ok", "_head", "_rest", "_fields", "_broken")


def quarantine(lines: DataFrame, members: DataFrame) -> DataFrame:
    """record_id, member_id, line_number, reason_code, physical_width, broken_field, raw_line of every line that fails."""
    return judge(lines, members).where("reason is not null").select(
        "record_id", "member_id", "line_number", F.col("reason").alias("reason_code"), F.col("width").alias("physical_width"), "broken_field", "raw_line"
    )


def loaded(lines: DataFrame, members: DataFrame) -> DataFrame:
    """The other lines as canonical rows: all 34 fields of `FIELD_MAP` as published (null where the layout lacks one), business_date and what it rests on, typed shadows *_value beside the numbers."""
    good = fixed(judge(lines, members).where("reason is null"), _f=fields(F.col("_line")))
    at = {fam: {n: i for i, (n, _) in enumerate(layout)} for fam, layout in LAYOUTS.items()}
    legacy = F.col("_format") == "legacy13"

    def pick(old, new):
        own = F.lit(None).cast("string") if old is None else F.col("_f")[at["legacy13"][old]]
        return F.when(legacy, own).otherwise(F.col("_f")[at["udiff34"][new]])

    rows = good.select("record_id", "member_id", "line_number", F.col("_format").alias("format_family"), "_day", *[pick(o, n).alias(c) for c, o, n in FIELD_MAP])
    stated, is_legacy = F.col("business_date"), F.col("format_family") == "legacy13"
    day = F.when(is_legacy, legacy_stamp(stated, F.col("_day"))["day"]).otherwise(stated.try_cast("date"))
    basis = F.when(~is_legacy, "udiff_traddt").when(F.length(stated) > 9, "legacy_row_date_four_digit_year").otherwise("legacy_row_date_two_digit_year_cross_checked_against_source_date")
    kinds = {c: dict(LEGACY)[o] for c, o, _ in FIELD_MAP if o and dict(LEGACY)[o] in ("decimal", "integer")}
    shadows = {f"{c}_value": F.col(c).try_cast("decimal(38,10)" if k == "decimal" else "bigint") for c, k in kinds.items()}
    return rows.withColumns({**shadows, "business_date_basis": basis, "business_date": day}).drop("_day")
