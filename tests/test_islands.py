"""Runs against brute force, with one key that holds half of the rows, and transitions of clear and unclear groups."""

import datetime as dt
import random

from tapelake.operators import islands as isl

DAY = dt.date(2020, 1, 1)


def brute(rows):
    """rows: (key, day, line, state)"""
    out, last = [], {}
    for key, day, _, state in sorted(rows, key=lambda r: (r[0], r[1] or dt.date.min, r[2])):
        run = last.get(key)
        if run is None or run["state"] != state:
            run = last[key] = {"key": key, "state": state, "days": [], "n": 0, "island": run["island"] + 1 if run else 1}
            out.append(run)
        run["days"].append(day)
        run["n"] += 1
    known = lambda r: [d for d in r["days"] if d]
    return sorted((r["key"], r["island"], str(r["state"]), min(known(r), default=None), max(known(r), default=None), len(set(known(r))), r["n"]) for r in out)


def test_runs_against_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for k in range(1500):
        key = "hot" if k % 2 else rnd.choice("abc")
        day = None if k % 97 == 0 else DAY + dt.timedelta(rnd.choice([rnd.randrange(3), rnd.randrange(400)]))
        rows.append((key, day, k, rnd.choice(["x", "x", "x", "y", None])))
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "key string, trade_date date, line int, state string, island string, _n int")
    got = isl.runs(df, ["key"], ["trade_date", "line"], ["state"])
    assert sorted((r.key, r.island, str(r.state), r.date_from, r.date_to, r.observed_dates, r.row_count) for r in got.collect()) == brute(rows)
    # Nothing sorts the rows of a whole key: every window over rows has the month in its key.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window" in x]
    assert windows and all("_month" in x for x in windows)
    assert isl.runs(df.limit(0), ["key"], ["trade_date", "line"], ["state"]).count() == 0


def test_runs_of_two_states_and_keys(spark):
    line = lambda k, d, a, b: ("k", "s" if k < 5 else "t", DAY + dt.timedelta(d), k, a, b)
    rows = [line(0, 0, "A", "1"), line(1, 31, "A", "1"), line(2, 31, "A", "2"), line(3, 62, "A", "2"), line(4, 93, None, "2"), line(5, 0, "A", "1")]
    df = spark.createDataFrame(rows, "k string, s string, trade_date date, line int, a string, b string")
    got = sorted(tuple(r) for r in isl.runs(df, ["k", "s"], ["trade_date", "line"], ["a", "b"]).select("s", "island", "b", "observed_dates", "row_count").collect())
    assert got == [("s", 1, "1", 2, 2), ("s", 2, "2", 2, 2), ("s", 3, "2", 1, 1), ("t", 1, "1", 1, 1)]


def rows_of(spark, seen):
    """seen: (identity, ticker, day)"""
    r = [(i, "EQ", t, t, DAY + dt.timedelta(d), "f", n, n) for n, (i, t, d) in enumerate(seen)]
    return spark.createDataFrame(r, "identity string, series string, ticker string, symbol string, trade_date date, file_name string, source_line_number int, row_id int")


def test_unclear_groups_have_no_transitions(spark):
    seen = [("A", "OLD", 0), ("A", "NEW", 3), ("B", "ONE", 0), ("B", "TWO", 2), ("B", "ONE", 5), ("C", "SHARED", 0), ("C", "LATER", 4), ("D", "SHARED", 1), ("E", "X", 2), ("E", "Y", 2)]
    r = rows_of(spark, seen)
    files = r.select("trade_date")
    census = isl.ticker_census(r)
    assert {x.identity for x in isl.ambiguous(census).collect()} == {"B", "C", "D", "E"}
    got = [tuple(x) for x in isl.transitions(isl.ticker_intervals(r), isl.day_ordinals(files), isl.ambiguous(census)).collect()]
    assert got == [("A", "EQ", "OLD", "NEW", DAY, DAY + dt.timedelta(3), 3, "SEQUENCE")]
    every = {(x.identity, x.from_ticker): (x.gap, x.kind) for x in isl.transitions(isl.ticker_intervals(r), isl.day_ordinals(files)).collect()}
    assert every["E", "X"] == (0, "SAME_DAY") and len(every) == 5


def test_day_ordinals_across_years(spark):
    days = [dt.date(y, m, 1) for y in (2021, 2019, 2020) for m in (3, 1, 2)]
    df = spark.createDataFrame([(d,) for d in [*days, *days, None]], "trade_date date")
    assert {r.trade_date: r.ordinal for r in isl.day_ordinals(df).collect()} == {d: i + 1 for i, d in enumerate(sorted(days))}
