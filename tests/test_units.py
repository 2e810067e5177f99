import datetime as dt  # noqa: F401
from decimal import Decimal

import pytest

from tapelake.operators import units

ROWS = "row_id bigint, member_id bigint, tottrdqty string, tottrdval string, price_close string, new_brd_lot_qty string, q string, shares string"
NOTES = {
    1: None, 2: "", 3: "Values in rupees, volumes in shares.", 4: "Turnover (Rs. Lakhs); TOTTRDQTY: '000 shares", 5: "Traded quantity (lakhs) / value column: figures in lacs of rupees",
    6: "Checked on arrival, over 2 lakh lines read; value in rupees, quantity in shares", 7: "No lakh or crore scaling here: turnover in rupees and quantity in single shares",
        8: "volume stated in board lots", 9: "Units: rupees / shares",
    10: "TOTTRDVAL in lakh; rest as usual", 11: "Turnover in INR mn", 12: "value figures: INR '000", 13: "over 3 lakh lines read",
}
# note, quantity, value, close, lot -> common quantity, common value (None: no case)
CASES = [
    (1, "100", "1000.00", "10", None, None, None), (1, "100", "1.00", "10", None, None, 100000), (1, "100000", "10", "10", None, None, 100000000), (1, "10000000", "10", "10", None, None, 10000000000),
    (1, None, "10", "10", None, None, None), (1, "100", "0", "10", None, None, None), (1, "100", "1", "0", None, None, None), (1, "100", "1", None, None, None, None), (13, "100", "1.00", "10",
        None, None, 100000),
    (3, "100", "1.00", "10", None, None, None), (9, "100", "1.00", "10", None, None, None), (6, "100", "1.00", "10", None, None, None), (7, "100", "1.00", "10", None, None, None),
    (4, "5", "2.5", "10", None, 5000, 25000000), (5, "1.5", "3", "10", None, 150000, 30000000), (10, "7", "3", "10", None, None, 30000000), (11, "7", "3", "10", None, None, 300000000), (12, "7",
        "3", "10", None, None, 300000),
    (8, "5", "100", "10", "25", 125, None), (8, "5", "100", "10", None, None, None), (8, "5", "100", "10", "1", 5, None), (1, "5 lots", "1250", "10", "25", 125, None), (1, "5 lots", "1250",
        "10", "x", None, None),
    (4, "12 shares", "Rs. 1,234.50", "10", None, 12, 123450), (4, "1,200", "1,2/-", "10", None, 1200000, None), (1, "1,200", "₹1.5 Cr.", "10", None, 1200, 1500000000), (1, "1.2K", "15 paise",
        "10", None, 1200, 15),
    (1, "0.5 mn", "INR 2 mn", "10", None, 500000, 200000000), (1, "12 nos.", "12,00,000/-", "10", None, 12, 120000000), (3, "1 lakh", "1.25E+3", "10", None, 100000, 125000), (3,
        "3 thousand shares", "1.005", "10", None, 3000, None),
    (3, "NA", "-", "10", None, None, None), (3, "", " ", "10", None, None, None), (3, "5 rupees", "5 shares", "10", None, None, None), (3, "1.2.3", "1e", "10", None, None, None), (3, "9" * 30,
        "9" * 30 + "K", "10", None, None, None),
    # More decimals than a paisa has, in the value, in a note, and guessed.
    (3, "100", "0.000004933 Crore", "10", None, None, 4933), (3, "100", "1.2345678905 cr", "10", None, None, 1234567891), (3, "100", "123456789.123456789012 Cr.", "10", None, None,
        123456789123456789),
    (4, "0.123456789012", "2.1234567891", "10", None, 123, 21234568), (10, "7", "0.000000000004", "10", None, None, 0), (1, "1000000", "1.000000493", "10", None, None, 1000000493), (1,
        "1000000", "0.999999999499", "10", None, None, 999999999),
    (10, "7", "0.00000004999999999999", "10", None, None, 0), (10, "7", "0.0000000500", "10", None, None, 1), (3, "1.0000000049999 lakh", "-0.0000000015 cr", "10", None, 100000, -2),
    (3, "-5", "-5 lakh", "10", None, -5, -50000000), (2, "1e400", "x" * 100000, "10", None, None, None), (3, " 100", "2,500", "10", None, 100, 250000), (3, "0.0005K", "0.005 paise", "10", None, 1, 0),
]


def frames(spark, cases):
    rows = spark.createDataFrame([(i, n, q, v, p, lot, "x", "y") for i, (n, q, v, p, lot, *_) in enumerate(cases)], ROWS)
    return rows, spark.createDataFrame([(k, v, "z") for k, v in NOTES.items()], "member_id bigint, units_note string, q string")


def test_cases(spark):
    rows, members = frames(spark, CASES)
    got = {(r.row_id, r.field_name): r.common_value for r in units.converted(rows, members).collect()}
    want = {(i, f): v for i, (*_, q, v2) in enumerate(CASES) for f, v in (("tottrdqty", q), ("tottrdval", v2)) if v is not None}
    assert {k: (got.get(k), want.get(k), CASES[k[0]]) for k in got.keys() | want.keys() if got.get(k) != want.get(k)} == {}


def test_repeats_unknown_member_and_empty(spark):
    rows, members = frames(spark, [(99, "5K", "5", "1", None), (None, "5K", None, "1", None)])
    # 5000 shares at 1 make a value of 5 thousands, so the first row has two cases, the second one.
    assert units.converted(rows.unionByName(rows), members).count() == 6
    assert units.converted(rows.limit(0), members).count() == 0
    assert units.converted(rows, members.limit(0)).count() == 3


@pytest.mark.parametrize("ratio,guess", [(1.0, 1), (0.04, 1), (0.03, 1000), (1e-3, 1000), (1e-5, 100000), (1e-7, 10000000), (1e-9, 10000000), (50.0, 1)])
def test_nearest_scale(spark, ratio, guess):
    from pyspark.sql import functions as F

    assert spark.range(1).select(units._nearest(F.lit(ratio))).first()[0] == guess


def test_unit_vectors():
    assert units.NOUNS["lots"].dims == units.NOUNS["share"].dims != units.NOUNS["paise"].dims
    assert (units.NOUNS["rupee"] * 100000).scale == 100 * 100000 and Decimal(units.SCALES["crore"]) == 10**7
