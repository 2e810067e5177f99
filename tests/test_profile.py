import datetime as dt

from pyspark.sql import functions as F

from tapelake.functions.isin import luhn_is_valid, validity
from tapelake.operators import profile

GOOD, BAD = "INE002A01018", "INE002A01019"
ROWS = (
    "row_id bigint, member_id bigint, source_line_number int, format_family string, symbol string, series string, isin string, sgmt string, src string, fininstrmtp string, price_open string, price_high string, "
    "price_low string, price_close string, price_last string, price_prev_close string, tottrdqty string, tottrdval string, totaltrades string, loaded_at timestamp, mask int, n int, feed string"
)


def row(i, member, line, isin, family="udiff34", series="EQ", price="1", at=dt.datetime(2020, 1, 1)):
    return (i, member, line, family, "S", series, isin, "CM", "X", "STK", price, "1", "1", "1", "1", "1", "1", "1", "1", at, 7, 8, "clash")


def tables(spark, rows, metrics=(), census=(), members=((1, "f", "2020-01-01"), (2, "f", "2020-01-02"), (3, "g", "2020-01-01"))):
    d = lambda df, *c: df.selectExpr(*[x for x in df.columns if x not in c], *[f"cast({x} as date) {x}" for x in c])
    return (
        spark.createDataFrame(rows, ROWS), d(spark.createDataFrame([*members], "member_id bigint, feed string, date_from_filename string"), "date_from_filename"),
        spark.createDataFrame([*metrics], "metric_id bigint, member_id bigint, blank_isin_rows bigint, invalid_isin_rows bigint"),
        d(spark.createDataFrame([*census], "group_id bigint, feed string, period_from string, period_to string, sgmt string, src string, fininstrmtp string, sctysrs string, blank_or_ws_isin_rows bigint"), "period_from", "period_to"),
    )


def test_codes(spark):
    cases = {"": "BLANK", " ": "BLANK", "INE144J0102": "LEN", "INE144J01020": "CHECKDIGIT", "US0378331005": "PREFIX", "IN00000000AB": "CHARSET", GOOD: "VALID", f" {GOOD.lower()}\t": "VALID",
        None: "BLANK"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r.x: r.v for r in df.select("x", validity(df.x).alias("v")).collect()}
    assert got == cases
    df = spark.createDataFrame([(GOOD,), (BAD,), ("US0378331005",), ("INE144J01027",)], "x string")
    assert [r[0] for r in df.select(luhn_is_valid(df.x)).collect()] == [True, False, True, True]


def test_findings(spark):
    a = [row(k, 1, k, GOOD) for k in range(10)]
    b = [row(100 + k, 2, k, GOOD if k < 6 else (" " if k < 8 else BAD), price="1" if k > 1 else "") for k in range(10)]
    again = [row(200, 2, 6, None, at=dt.datetime(2020, 2, 1)), row(201, 2, 9, GOOD, at=None)]
    lost = [row(300, 3, None, None), row(301, 3, None, None)]
    metrics = [(1, 1, 0, 0), (2, 2, 2, 2), (3, 2, None, 3), (4, 3, 2, None), (5, 9, 0, 0), (6, None, 0, 1)]
    census = [(1, "f", "2020-01-01", "2020-01-02", "CM", "X", "STK", " eq", 2), (2, "f", "2020-01-01", "2020-01-01", "CM", "X", "STK", "EQ", 2), (3, "f", "2020-01-01", "2020-01-02", "CM", "X",
        None, "EQ", 0), (4, "h", None, None, None, None, None, None, None)]
    got = sorted(tuple(r) for r in profile.findings(*[t for t in (lambda x: (x[0], x[1], x[2], x[3]))(tables(spark, a + b + again + lost, metrics, census))]).select("table_name", "row_key",
        "field_name", "finding").collect())
    assert got == sorted([
        ("file_metrics", 3, "blank_isin_rows", "wrong_count"), ("file_metrics", 3, "invalid_isin_rows", "wrong_count"), ("file_metrics", 4, "invalid_isin_rows", "wrong_count"), ("file_metrics",
            6, "invalid_isin_rows", "wrong_count"),
        ("ud_census_groups", 2, "blank_or_ws_isin_rows", "wrong_count"), ("ud_census_groups", 4, "blank_or_ws_isin_rows", "wrong_count"),
        ("members", 2, "isin", "blank_jump"), ("members", 2, "isin", "pattern_jump"), ("members", 2, "price_open", "blank_jump"),
    ])


def test_threshold_is_exclusive_and_empty_tables(spark):
    a = [row(k, 1, k, GOOD) for k in range(20)]
    b = [row(100 + k, 2, k, GOOD if k >= 3 else "") for k in range(20)]
    t = tables(spark, a + b)
    assert profile.findings(*t).count() == 0
    assert profile.findings(*[x.limit(0) for x in t]).count() == 0
    assert profile.column_profile(t[0]).where("field_name = 'isin' and member_id = 2").first().blanks == 3
    assert profile.control_limits(profile.states(profile.row_masks(t[0])), t[1]).count() == 0
    assert profile.control_limits(profile.states(profile.row_masks(t[0].limit(0))), t[1]).count() == 0


def test_control_limits_find_a_planted_jump(spark):
    day = lambda k: str(dt.date(2020, 1, 1) + dt.timedelta(9 * k))  # noqa: E731 - several months
    rows = [row(100 * m + k, m, k, "" if k < (6 if m == 15 else m % 2) else GOOD) for m in range(20) for k in range(10)]
    members = [(m, None if m == 99 else "f", day(m)) for m in range(20)]
    df, per = tables(spark, rows, members=members)[:2]
    state = profile.states(profile.row_masks(df))
    got = profile.control_limits(state, per).collect()
    assert [(r.member_id, r.metric, r.share) for r in got] == [(15, "blank_isin", 0.6)]
    shares = [0.1 * (m % 2) for m in range(15)]
    mean = sum(shares) / 15
    assert abs(got[0]["mean"] - mean) < 1e-12 and abs(got[0]["limit"] - mean - 3 * (sum((x - mean) ** 2 for x in shares) / 15) ** 0.5) < 1e-9


def test_states_are_kept_between_loads(spark, tmp_path):
    a = [row(k, 1, k, GOOD) for k in range(10)] + [row(50 + k, 2, k, "") for k in range(10)]
    late = [row(100 + k, 2, k, GOOD, at=dt.datetime(2020, 3, 1)) for k in range(5)]
    new = [row(200 + k, 3, k, BAD) for k in range(4)]
    store = profile.StateStore(spark, str(tmp_path / "states"))
    store.add(tables(spark, a)[0], 1)
    both = tables(spark, a + late + new)[0]
    store.add(both.where("member_id in (2, 3)"), 2)  # member 1 is not counted again
    store.add(both.where("member_id in (2, 3)"), 2)
    whole = profile.states(profile.row_masks(both))
    assert sorted(map(tuple, store.states().select(*whole.columns).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    t = tables(spark, a + late + new, [(1, 3, 0, 4), (2, 2, 5, 0)])
    found = lambda df: sorted(map(tuple, df.collect()))
    assert found(profile.findings_of(store.states(), *t[1:])) == found(profile.findings(*t))


def test_states_merge(spark):
    rows = [row(k, k % 3, k, [GOOD, BAD, ""][k % 3]) for k in range(60)]
    df = tables(spark, rows)[0]
    whole = profile.merge(profile.states(profile.row_masks(df)), ["member_id"])
    parts = profile.states(profile.row_masks(df.where("row_id < 25"))).unionByName(profile.states(profile.row_masks(df.where("row_id >= 25"))))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, profile.merge(parts, ["member_id"]).collect()))


def test_profile_of_every_column(spark):
    later = dt.datetime(2020, 2, 1)
    a = [row(1, 1, 1, BAD, price="10"), row(2, 1, 2, "", price="9"), row(3, 1, 3, GOOD.lower(), price=" "), row(4, 1, 4, None, price="x"), row(5, 1, 1, GOOD, price="-0.5", at=later)]
    df = tables(spark, a + [row(6, 2, 1, BAD, series="02-JAN-2020"), row(7, 2, 2, GOOD, series="2019-12-31"), row(8, 2, 3, GOOD, series="31-FEB-2020")])[0]
    out = profile.column_profile(df)
    got = {(r.member_id, r.field_name): r for r in out.collect()}
    assert {f for _, f in got} == set(df.columns) and {r.rows for (m, _), r in got.items() if m == 1} == {4}
    price, isin, series = got[1, "price_open"], got[1, "isin"], got[2, "series"]
    assert (price.blanks, price.numbers, float(price.least_number), float(price.greatest_number), price.least_text, price.greatest_text) == (1, 2, -0.5, 9.0, "x", "x")
    assert (isin.blanks, isin.codes, isin.numbers, got[2, "isin"].codes) == (2, 2, 0, 2)
    assert (series.dates, str(series.least_date), str(series.greatest_date), series.least_text) == (2, "2019-12-31", "2020-01-02", "31-FEB-2020")
    assert (int(got[1, "row_id"].least_number), int(got[1, "row_id"].greatest_number), got[1, "loaded_at"].dates, str(got[1, "loaded_at"].greatest_date)) == (2, 5, 4, "2020-02-01")
    merged = {r.field_name: r.n for r in out.groupBy("field_name").agg(F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n")).collect()}
    assert (merged["isin"], merged["row_id"], merged["member_id"], got[1, "isin"].distinct_estimate) == (3, 7, 2, 2)
