from tapelake.functions.dates import iso_pattern, stamp_pattern
from tapelake.operators import quarantine
from tapelake.schema import FIELD_MAP, LEGACY, UDIFF

LINES = "record_id bigint, member_id bigint, line_number int, physical_width int, raw_line string, reason_code string, width string, _line string"
MEMBERS = "member_id bigint, detected_format string, header_width int, date_from_filename string, reason string"
OLD = "ABC,EQ,1,2,3,4,5,6,7,8.5,20-SEP-2016,9,INX000000000"
NEW = ",".join({"TradDt": "2024-02-29", "OpnPric": "1.5", "TtlTradgVol": "10"}.get(n, "") for n, _ in UDIFF)


def found(spark, cases):
    m = [(1, "legacy13", 13, "2016-09-20", "x"), (2, "legacy13", 14, "2016-09-20", "x"), (3, "udiff34", 34, "2024-02-29", "x"), (4, None, None, None, "x"), (5, "legacy13", None, None, "x")]
    members = spark.createDataFrame(m, MEMBERS).selectExpr("member_id", "detected_format", "header_width", "cast(date_from_filename as date) date_from_filename", "reason")
    lines = spark.createDataFrame([(i, k, i, None, x, None, "w", "l") for i, (k, x, _) in enumerate(cases)], LINES)
    got = {r.record_id: r for r in quarantine.quarantine(lines, members).collect()}
    ok = {r.record_id for r in quarantine.loaded(lines, members).collect()}
    assert ok | set(got) == set(range(len(cases))) and not ok & set(got)
    return got


def test_reasons(spark):
    stamp = lambda d: OLD.replace("20-SEP-2016", d)
    cases = [
        (1, OLD, None), (2, OLD + ",", None), (2, OLD + ',""', None), (1, OLD + ",", "row_fieldcount_mismatch"), (2, OLD, "row_fieldcount_mismatch"), (2, OLD + ",x", "row_fieldcount_mismatch"),
        (3, NEW, None), (3, NEW + ",", "row_fieldcount_mismatch"), (1, "", "empty_interior_line"), (1, None, "empty_interior_line"), (1, " ", "row_fieldcount_mismatch"),
        (1, OLD.replace("ABC", '"A,""B"'), None), (1, OLD.replace("ABC", 'A"B'), None), (1, OLD.replace("ABC", '"A"B'), "csv_syntax_error"), (1, OLD.replace("ABC", '"AB'), "csv_syntax_error"),
            (1, OLD + ',"', "csv_syntax_error"),
        (1, stamp(""), "legacy_timestamp_blank"), (1, stamp('""'), "legacy_timestamp_blank"), (1, stamp("20-Sep-16"), None), (1, stamp("21-Sep-16"), "legacy_two_digit_year_unresolvable"), (1,
            stamp("31-FEB-2016"), "legacy_timestamp_unparseable"),
        (1, stamp("31-FEB-16"), "legacy_timestamp_unparseable"), (1, stamp("29-feb-2016"), None), (1, stamp("29-FEB-2015"), "legacy_timestamp_unparseable"), (1, stamp("20-XXX-2016"),
            "legacy_timestamp_unparseable"), (1, stamp("20-SEP-2016 15:30"), "legacy_timestamp_unparseable"),
        (1, stamp("2016-09-20"), "legacy_timestamp_unparseable"), (5, stamp("20-Sep-16"), "legacy_two_digit_year_unresolvable"), (5, OLD + ",", None), (4, OLD, "row_fieldcount_mismatch"), (9,
            OLD, "row_fieldcount_mismatch"),
        (1, OLD.replace("8.5", "8."), "numeric_field_unparseable"), (1, OLD.replace("8.5", '"1,2"'), "numeric_field_unparseable"), (1, OLD.replace("8.5", "1e5"), "numeric_field_unparseable"),
            (1, OLD.replace(",7,", ",7.0,"), "numeric_field_unparseable"),
        (1, OLD.replace(",7,", ", 7,"), "numeric_field_unparseable"), (1, OLD.replace(",7,", ",,"), None), (1, OLD.replace(",7,", ",-7,"), None), (1, OLD.replace(",7,", ",٧,"),
            "numeric_field_unparseable"), (1, OLD + "\n", None),
        (3, NEW.replace("2024-02-29", "2023-02-29"), "udiff_traddt_unparseable"), (3, NEW.replace("1.5", "+1.5"), "numeric_field_unparseable"), (3, NEW.replace("2024-02-29", "x").replace("1.5",
            "y"), "udiff_traddt_unparseable"),
        (1, "a," * 20000, "row_fieldcount_mismatch"), (1, OLD.replace("ABC", '"' + 'x""' * 50000 + '"'), None), (1, OLD.replace("ABC", "x" * 300000), None),
    ]
    got = found(spark, cases)
    wrong = {i: (c[1] and c[1][:60], c[2], got.get(i) and got[i].reason_code) for i, c in enumerate(cases) if (got[i].reason_code if i in got else None) != c[2]}
    assert not wrong
    assert got[35].broken_field == "TOTTRDQTY" and got[41].broken_field == "OpnPric" and got[16].broken_field == "TIMESTAMP"
    # A quote that stays open breaks its own field; a line that is too short lacks its next one.
    assert got[13].broken_field == got[14].broken_field == "SYMBOL" and got[4].broken_field is None and got[10].broken_field == "SERIES" and got[7].broken_field is None
    assert got[43].physical_width == 20001


def test_loaded_rows_keep_text(spark):
    members = spark.createDataFrame([(1, "legacy13", 13)], "member_id bigint, detected_format string, header_width int").selectExpr("*", "date '2016-09-20' as date_from_filename")
    lines = spark.createDataFrame([(1, 1, 2, OLD.replace("ABC", '"A,""B"').replace("20-SEP-2016", "20-Sep-16"))], "record_id bigint, member_id bigint, line_number int, raw_line string")
    r = quarantine.loaded(lines, members).first()
    assert r.listing_symbol == 'A,"B' and str(r.business_date) == "2016-09-20" and r.traded_quantity == "7" and r.traded_quantity_value == 7 and r.segment is None
    assert r.raw_biz_dt == "20-Sep-16" and r.business_date_basis.startswith("legacy_row_date_two_digit")
    assert {c for c, _, _ in FIELD_MAP} <= set(r.asDict()) and len(FIELD_MAP) == 34


def test_every_modern_field_is_loaded(spark):
    values = {n: f"v{i}" for i, (n, k) in enumerate(UDIFF) if k == "text"} | {n: "2024-02-29" for n, k in UDIFF if k == "iso"} | {n: str(i) for i, (n, k) in enumerate(UDIFF) if k in ("decimal",
        "integer")}
    members = spark.createDataFrame([(1, "udiff34", 34)], "member_id bigint, detected_format string, header_width int").selectExpr("*", "date '2024-02-29' as date_from_filename")
    lines = spark.createDataFrame([(1, 1, 2, ",".join(values[n] for n, _ in UDIFF))], "record_id bigint, member_id bigint, line_number int, raw_line string")
    r = quarantine.loaded(lines, members).first().asDict()
    assert {c: str(r[c]) for c, _, _ in FIELD_MAP} == {c: values[n] for c, _, n in FIELD_MAP}
    assert sorted(n for _, _, n in FIELD_MAP) == sorted(n for n, _ in UDIFF)


def test_empty(spark):
    lines, members = spark.createDataFrame([], LINES), spark.createDataFrame([], MEMBERS).selectExpr("member_id", "detected_format", "header_width",
        "cast(date_from_filename as date) date_from_filename")
    assert quarantine.quarantine(lines, members).count() == 0 and quarantine.loaded(lines, members).count() == 0


def test_generated_dates():
    import datetime as dt
    import re

    day, iso = re.compile(stamp_pattern()), re.compile(iso_pattern())
    for y in (1900, 2000, 2015, 2016):
        for n in range(-1, 367):
            d = dt.date(y, 1, 1) + dt.timedelta(n)
            assert day.fullmatch(d.strftime("%d-%b-%Y")) and iso.fullmatch(str(d))
    for bad in ("1900-02-29", "2015-02-29", "2016-04-31", "2016-00-10", "2016-13-01", "0000-01-01", "2016-1-01"):
        assert not iso.fullmatch(bad)
    assert len(LEGACY) == 13 and len(UDIFF) == 34
