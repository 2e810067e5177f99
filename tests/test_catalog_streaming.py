import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapelake import streaming
from tapelake.operators import calendar, islands
from tapelake.plans import catalog

A, B = "INE002A01018", "INE009A01021"
ROWS = "row_id bigint, trade_date string, ticker string, series string, identity string, isin_n string, file_name string, source_line_number int, format_family string, sgmt string, src string, fininstrmtp string, validity string"


def tables(spark, obs):
    """obs: (day, ticker, series, identity)."""
    rows = [(i, d, t, s, x, x or "", f"f{d}", i + 1, "udiff34" if d >= "2024" else "legacy13", "CM", "X", "STK", "VALID" if x else "BLANK") for i, (d, t, s, x) in enumerate(obs)]
    r = spark.createDataFrame(rows, ROWS).withColumn("trade_date", F.to_date("trade_date")).withColumn("year", F.year("trade_date")).withColumn("symbol", F.col("ticker")).withColumn("member_id",
        F.unix_date("trade_date").cast("bigint"))
    m = r.select("member_id", F.lit("R").alias("root"), "file_name", F.col("file_name").alias("relative_path"), F.lit("x").alias("sha256"), F.col("format_family").alias("detected_format"),
        F.col("trade_date").alias("date_from_filename"), F.lit(1).alias("row_count")).distinct()
    x = m.select("member_id", F.lit(1).alias("metric_id"), "row_count", F.lit(0).alias("blank_isin_rows"), F.lit(0).alias("invalid_isin_rows"))
    return catalog.Tables(r, m, x)


def test_instrument_follows_the_identity(spark):
    t = tables(spark, [("2020-01-01", "OLD", "EQ", A), ("2020-01-02", "NEW", "EQ", A), ("2020-01-03", "NEW", "EQ", None), ("2020-01-03", "X", "EQ", B)])
    assert catalog.run(t, "instrument", symbol="NEW", series="EQ").count() == 3
    assert catalog.run(t, "instrument", symbol="OLD", series="EQ").count() == 2
    assert catalog.run(t, "instrument", symbol="OLD", series="EQ", year=2021).count() == 0
    assert catalog.run(t, "instrument", symbol="NONE", series="EQ").count() == 0
    got = catalog.run(t, "association", symbol="NEW", series="EQ").orderBy("date_from").collect()
    assert [(r.symbol, r.tickers) for r in got] == [("OLD", "OLD"), ("NEW", "NEW")]


@pytest.mark.parametrize("obs", [
    [("2020-01-01", "S", "EQ", A), ("2021-01-01", "S", "EQ", B)],
    [("2020-01-01", "S", "EQ", A), ("2020-01-02", "N", "EQ", A), ("2020-01-03", "S", "EQ", A)],
    [("2020-01-01", "S", "EQ", A), ("2020-01-01", "N", "EQ", A)],
])
def test_ambiguous_tickers(spark, obs):
    with pytest.raises(catalog.QueryError):
        catalog.run(tables(spark, obs), "instrument", symbol="S", series="EQ", year=2020)


def test_parameters(spark):
    t = tables(spark, [("2020-01-01", "S", "EQ", A), ("2024-01-03", "S", "BE", A)])
    bad = [("date-range", {}), ("date-range", {"date_from": "2020-1-1", "date_to": "2020-01-02"}), ("date-range", {"date_from": "2020-02-30", "date_to": "2020-03-02"}), ("filter",
        {"filters": {}}), ("filter", {"filters": {"nope": "x"}}), ("filter", {"filters": {"series": 1}}), ("association", {}), ("association", {"symbol": "S"}), ("calendar",
            {"date_from": "2020-01-01"}), ("record-detail", {"source_file": "f2020-01-01", "source_line_number": 0}), ("record-detail", {"source_file": "nope", "source_line_number": 1}),
                ("dataset", {"what": 1}), ("nope", {}), ("production_ingestion", {})]
    for mode, params in bad:
        with pytest.raises(catalog.QueryError):
            catalog.run(t, mode, **params)
    assert catalog.run(t, "date-range", date_from="2021-01-01", date_to="2020-01-01").count() == 0
    assert catalog.run(t, "filter", filters={"series": "EQ", "segment": "CM"}).count() == 1
    assert catalog.run(t, "record-detail", source_file="f2020-01-01", source_line_number=1).first().reconciliation[0].metric_id == 1
    assert {(r.format_family, r.row_count) for r in catalog.run(t, "dataset").collect()} == {("legacy13", 1), ("udiff34", 1), (None, 2)}
    assert catalog.run(t, "archive-inventory").count() == 2 and catalog.run(t, "data-quality").first().row_count == 2
    assert catalog.run(t, "date-range", **catalog.latest_years(t, 1)).count() == 1
    t.evidence = spark.createDataFrame([("r1", "x"), ("r2", "x"), (None, "x"), (None, None)], "run string, sha string")
    assert [r.state for r in catalog.run(t, "qualification", bindings={"run": "r1", "sha": "x"}).collect()] == ["associated", "not-associated", "associated", "not-identity-bound"]
    s = "run string, sha string, present boolean, readable boolean, said_sha256 string, actual_sha256 string"
    t.evidence = spark.createDataFrame([("r1", "x", False, None, None, None), ("r1", "x", True, False, None, None), ("r1", "x", None, None, "a", "b"), (None, None, True, True, "a", "a"), ("r1",
        "y", True, True, None, None), ("r1", None, True, True, None, "a")], s)
    got = [(r.state, r.basis) for r in catalog.run(t, "qualification", bindings={"run": "r1", "sha": "x"}).collect()]
    assert [x for x, _ in got] == list(catalog.STATES) and got[4][1] == "mismatch: sha" and got[5][1] == "holds: run" and len(catalog.UNSUPPORTED) == 18


def test_store(spark, tmp_path):
    t, s = tables(spark, [("2020-01-01", "S", "EQ", A)]), catalog.Store(str(tmp_path / "s.json"))
    s.save("mine", "filter", {"filters": {"series": "EQ"}})
    with pytest.raises(catalog.QueryError):
        s.save("bad", "filter", {})
    assert s.names() == ["mine"] and s.run(t, "mine").count() == 1 and s.run(t, "mine").count() == 1
    s.forget(2)
    s.run(t, "mine")
    assert [h["seq"] for h in s.history()] == [1, 3]
    s.delete("mine")
    with pytest.raises(catalog.QueryError):
        s.run(t, "mine")


def test_associations(spark):
    t = tables(spark, [("2020-07-05", "T", "EQ", A), ("2020-07-06", "T", "BE", A), ("2020-07-07", "T", "EQ", A), ("2020-07-05", "U", "EQ", B), ("2020-07-09", "U", "EQ", B)])
    got = {(r.isin_n, r.island, r.series, str(r.date_from)[5:], str(r.date_to)[5:], r.observed_dates) for r in islands.associations(t.rows).collect()}
    assert got == {(A, 1, "EQ", "07-05", "07-05", 1), (A, 2, "BE", "07-06", "07-06", 1), (A, 3, "EQ", "07-07", "07-07", 1), (B, 1, "EQ", "07-05", "07-09", 2)}


def test_overlays(spark):
    s = "row_id bigint, member_id bigint, source_line_number int, series string, isin_n string, symbol string, quantity bigint"
    rows = [(1, 1, 1, "BL", A, "S", 5), (2, 1, 2, "EQ", A, "S", 9), (3, 1, 3, "BE", A, "S", 1), (4, 1, 4, "bl", A, "S", 1), (5, 1, 5, "IL", B, "T", 1), (6, 1, 6, "BO", "", "U", 1), (7, 2, 1,
        "T0", A, "S", None), (8, 2, 2, None, A, "S", 1)]
    got = {r.row_id: (r.base_series, r.candidates, r.relation) for r in islands.link_overlays(spark.createDataFrame(rows, s), ("BL", "BO", "T0", "IT", "IL")).collect()}
    assert got == {1: ("EQ", 3, "lt"), 5: (None, None, "unknown"), 6: (None, None, "unknown"), 7: (None, 1, "unknown")}


def test_calendar_labels(spark):
    d = lambda x: dt.date.fromisoformat(x)
    files = spark.createDataFrame([(d("2024-03-04"), "legacy13", "a"), (d("2024-03-06"), "legacy13", "b"), (d("2024-03-11"), "udiff34", "c"), (None, "udiff34", "z")],
        "trade_date date, family string, file_name string")
    holidays = spark.createDataFrame([(d("2024-03-08"), "Fair"), (d("2024-03-11"), "Odd")], "trade_date date, holiday string")
    cal = {str(r.trade_date)[8:]: r.label for r in calendar.calendar(files, holidays).collect()}
    assert cal == {"04": "not-applicable", "05": "not-retrieved", "06": "not-applicable", "07": "unexplained", "08": "official-holiday", "09": "weekend", "10": "weekend", "11": "official-holiday"}
    one = calendar.arithmetic_closes(calendar.calendar(files, holidays)).first()
    assert one.closes and (one.weekdays, one.file_days, one.missing_weekdays) == (6, 3, 3)
    assert calendar.calendar(files.limit(0)).count() == 0


def test_streams(spark, tmp_path):
    s = "key string, at timestamp, seq bigint, state string"
    rows = [("a", dt.datetime(2020, 1, 1, 1), 1, "EQ"), ("a", dt.datetime(2020, 1, 1, 2), 2, "EQ"), ("a", dt.datetime(2020, 1, 1, 3), 3, "BE"), ("b", dt.datetime(2020, 1, 1, 1), 4, "EQ")]
    spark.createDataFrame(rows, s).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = streaming.file_stream(spark, str(tmp_path / "in"), s)
    got = []
    streaming.each_batch(stream, lambda b, i: got.append((i, b.groupBy("key").count().count())), str(tmp_path / "c1")).awaitTermination()
    assert got == [(0, 2)]
    q = streaming.state_changes(stream).writeStream.format("memory").queryName("changes").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.key, r.before, r.state) for r in spark.table("changes").collect()} == {("a", None, "EQ"), ("a", "EQ", "BE"), ("b", None, "EQ")}
    q = streaming.windowed_counts(stream, "at", ["key"]).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation",
        str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").count() == 4
