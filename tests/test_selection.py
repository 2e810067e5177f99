"""Searches along the calendar against brute force."""

import datetime as dt
import random

from tapelake.plans import engine


def test_first_file_has_no_limit(spark):
    rnd = random.Random(4)
    day = lambda: dt.date(1995, 1, 1) + dt.timedelta(rnd.randrange(9000))
    asked = [day() for _ in range(200)] + [None]
    files = [(f"f{rnd.randrange(50):02d}", d, rnd.choice(["a", "b"])) for d in [day() for _ in range(12)] + asked[:2] * 2] + [("x", None, "a"), ("x", day(), None)]
    got = engine.select_files(spark.createDataFrame([(d,) for d in asked], "asked date"), spark.createDataFrame(files, "file_name string, date_from_filename date, detected_format string"))
    want = set()
    for a in set(asked) - {None}:
        for k in "ab":
            want.add((a, k, *min(((d, n) for n, d, f in files if f == k and d and d >= a), default=(None, None))[::-1]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(w[3] and (w[3] - w[0]).days > 400 for w in want)


def test_shift_of_the_formats(spark):
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(k)
    members = [(day(k), "legacy13") for k in range(6)] + [(day(5), "legacy13")] + [(day(k), "udiff34") for k in range(6, 9)] + [(None, "udiff34")]
    r = [("legacy13", day(0), "OLD")] + [("legacy13", day(k), "EQ") for k in (2, 3, 4, 5, 5)] + [("legacy13", day(2), "BE"), ("udiff34", day(6), "EQ"), ("udiff34", day(7), "NEW"), ("udiff34",
        day(8), None)]
    args = spark.createDataFrame(r, "format_family string, trade_date date, series string"), spark.createDataFrame(members, "date_from_filename date, detected_format string")
    got = {x.series: (x.legacy_average, x.modern_average, x.delta) for x in engine.shift(*args, days=4).collect()}
    assert got == {"EQ": (5 / 4, 1 / 3, 1 / 3 - 5 / 4), "BE": (1 / 4, 0, -1 / 4), "NEW": (0, 1 / 3, 1 / 3)}
