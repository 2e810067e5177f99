import datetime as dt
import random

from tapelake.operators import history, intervals

SCHEMA = "obs_id bigint, identity string, ticker string, series string, raw_symbol string, date_from string, date_to string, loaded_at timestamp, key string, lo int, won string, level int"


def tickers(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def some(seed, n=200):
    """Overlapping, nested, repeated, blank, null and reversed observations of a few identities; one holds a third."""
    rnd = random.Random(seed)
    start = dt.date(2019, 12, 1)
    out = []
    for k in range(n):
        f = start + dt.timedelta(rnd.randrange(400))
        t = f + dt.timedelta(rnd.choice([-3, 0, 0, 1, 5, 40, 130, 300]))
        ident = "HOT" if k % 3 == 0 else rnd.choice([" a", "A ", "b", "C", None])
        at = dt.datetime(2021, 1, rnd.randrange(1, 4)) if rnd.random() > 0.1 else None
        out.append((k, ident, rnd.choice(["t", "T ", "U", None] if k % 17 == 0 else ["t", "U"]), rnd.choice(["EQ", "be"]), "", str(f) if rnd.random() > 0.03 else None,
            str(t) if rnd.random() > 0.05 else None, at))
    return out + out[:5]


def brute(rows, end="2026-09-18"):
    held, covered = {}, {}
    for k, i, t, s, _, f, to, at in rows:
        if i is None or f is None:
            continue
        i, a, b = i.strip().upper(), dt.date.fromisoformat(f), dt.date.fromisoformat(to or end)
        for d in (a + dt.timedelta(x) for x in range((b - a).days + 1)):
            covered.setdefault(i, set()).add(d)
            if t is not None and s is not None:
                new = ((at or dt.datetime.min), k, t.strip().upper(), s.strip().upper())
                held.setdefault(i, {})[d] = max(held.get(i, {}).get(d, (dt.datetime.min, -1, "", "")), new)
    versions = set()
    for i, days in held.items():
        run = None
        for d in sorted(days):
            state = days[d][2:]
            if run and run[0] == state:
                run = (state, run[1], d)
            else:
                if run:
                    versions.add((i, *run[0], str(run[1]), str(run[2])))
                run = (state, d, d)
        versions.add((i, *run[0], str(run[1]), str(run[2])))
    periods = set()
    one = dt.timedelta(1)
    for i, days in covered.items():
        ends = []
        for d in sorted(days):
            if ends and ends[-1][1] + one == d:
                ends[-1][1] = d
            else:
                ends.append([d, d])
        periods |= {(i, "period", str(a), str(b)) for a, b in ends}
        periods |= {(i, "gap", str(x[1] + one), str(y[0] - one)) for x, y in zip(ends, ends[1:])}
    return versions, periods


def test_against_brute_force(spark):
    for seed in range(3):
        rows = some(seed)
        df = tickers(spark, rows)
        versions, periods = brute(rows)
        got = [tuple(r) for r in history.ticker_history(df).collect()]
        assert len(got) == len(set(got)) and set(got) == versions
        got = [tuple(r) for r in intervals.ticker_periods(df).collect()]
        assert len(got) == len(set(got)) and set(got) == periods


def test_empty_and_unusable(spark):
    for rows in ([], [(1, None, "a", "b", "", "2020-01-01", None, None)], [(1, "x", "a", "b", "", "2020-13-01", None, None)], [(1, "x", "a", "b", "", "2020-01-02", "2020-01-01", None)]):
        df = tickers(spark, rows)
        assert history.ticker_history(df).count() == 0
        assert intervals.ticker_periods(df).count() == 0


def test_ties_and_open_end(spark):
    at = dt.datetime(2020, 1, 1)
    rows = [(1, "x", "a", "S", "", "2026-09-10", None, at), (2, "x", "b", "S", "", "2026-09-12", "2026-09-13", at)]
    got = {tuple(r)[1:] for r in history.ticker_history(tickers(spark, rows)).collect()}
    assert got == {("A", "S", "2026-09-10", "2026-09-11"), ("B", "S", "2026-09-12", "2026-09-13"), ("A", "S", "2026-09-14", "2026-09-18")}


def test_satellites_hold_only_changes(spark):
    rows = [(1, "x", "a", "S", "", "2020-01-01", "2020-01-05", None), (2, "x", "a", "T", "", "2020-01-06", "2020-01-09", None), (3, "x", "a", "T", "", "2020-02-06", "2020-02-09", None)]
    sats = history.satellites(history.resolve_spans(history.observations(tickers(spark, rows)), ["ticker", "series"]), history.GROUPS)
    assert {(r.satellite, r.n) for r in sats.groupBy("satellite").count().withColumnRenamed("count", "n").collect()} == {("ticker", 1), ("series", 2), ("", 1)}


def test_snapshots_append_only_changes(spark):
    s = lambda rows: spark.createDataFrame(rows, "id int, a string, b string")
    none = spark.createDataFrame([], "id int, a string, b string, valid_from date, hash bigint")
    first = history.append_snapshot(none, s([(1, "x", None), (2, "y", "z"), (None, "q", "q"), (2, "y", "z")]), ["id"], ["a", "b"], "2020-01-01")
    assert sorted(r.id for r in first.collect()) == [1, 2]
    second = history.append_snapshot(first, s([(1, "x", None), (2, "y", None), (3, "", "")]), ["id"], ["a", "b"], "2020-02-01")
    assert sorted(r.id for r in second.collect()) == [2, 3]
    view = history.snapshot_view(first.unionByName(second), ["id"])
    assert {(r.id, str(r.valid_from), str(r.valid_to)) for r in view.collect()} == {(1, "2020-01-01", "None"), (2, "2020-01-01", "2020-01-31"), (2, "2020-02-01", "None"), (3, "2020-02-01", "None")}


def test_dyadic_blocks_are_canonical(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([(0, 0), (3, 9), (5, 1000), (64, 127), (1, 2**21)])], "i int, lo bigint, hi bigint")
    for r in intervals.dyadic_blocks(df, "lo", "hi").groupBy("i", "lo", "hi").agg({"level": "count"}).collect():
        assert r["count(level)"] <= 2 * 22
    days = {}
    for r in intervals.dyadic_blocks(df.where("hi <= 1000"), "lo", "hi").collect():
        assert r.start % (1 << r.level) == 0
        for d in range(r.start, r.start + (1 << r.level)):
            assert d not in days.setdefault(r.i, set())
            days[r.i].add(d)
    assert days == {0: {0}, 1: set(range(3, 10)), 2: set(range(5, 1001)), 3: set(range(64, 128))}


def test_loads_only_append(spark, tmp_path):
    from pyspark.sql import functions as F

    rnd = random.Random(11)
    s = "identity string, ticker string, series string, date_from string, date_to string, loaded_at timestamp, obs_id bigint"
    rows = []
    for k in range(240):
        a = dt.date(2020, 1, 1) + dt.timedelta(rnd.randrange(200))
        at = dt.datetime(2021, 1, 1) + dt.timedelta(k)
        rows.append((rnd.choice("abcdef"), rnd.choice("TUV"), rnd.choice(["EQ", "BE"]), str(a), str(a + dt.timedelta(rnd.randrange(30))), at, k))
    first, second = rows[:200], [r for r in rows[200:] if r[0] in "ab"]
    store = history.SatelliteStore(spark, str(tmp_path / "store"))
    frame = lambda x: spark.createDataFrame(x, s)
    keys = lambda x: spark.createDataFrame([(r[0].upper(),) for r in x], "key string")
    so_far = frame(first + second)
    store.add(history.observations(frame(first)), keys(first), 1)
    store.add(history.observations(so_far), keys(second), 2)
    added = spark.read.parquet(f"{store.path}/satellites/load=2")
    assert {r.key for r in added.select("key").distinct().collect()} <= {"A", "B"} and 0 < added.count() < store.rows().count()
    day = lambda c: F.date_from_unix_date(c).cast("string").alias(c)
    got = store.view().select(F.col("key").alias("identity"), "ticker", "series", day("date_from"), day("date_to"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, history.ticker_history(so_far).collect()))
    # The same observations again add nothing.
    store.add(history.observations(so_far), keys(second), 3)
    assert spark.read.parquet(f"{store.path}/satellites/load=3").count() == 0
