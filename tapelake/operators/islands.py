"""Gaps and islands over ordered observations, and what follows from them.

Runs are found month by month: rows are sorted within (key, month) only, and what crosses a
month's border is one row a month and key, which says how many runs the month has and how it
begins and ends. So a key that holds a tenth of all rows is no single task's sort. Keys must not
be null; callers filter them. Ties of the order given are the caller's to break.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NO_DAY = -(1 << 30)


def runs(rows: DataFrame, keys: list[str], order: list[str], state: list[str], day: str = "trade_date") -> DataFrame:
    """keys, state, island, date_from, date_to, observed_dates, row_count of each longest run of equal `state` in `order` within `keys`.

    `order` starts with `day`, a date; rows without one come first. Islands of a key are numbered from 1.
    """
    columns = list(dict.fromkeys([*keys, *order, *state, day]))
    month = F.coalesce(F.year(day) * 12 + F.month(day), F.lit(_NO_DAY)).alias("_month")
    inner = Window.partitionBy(*keys, "_month").orderBy(*order)
    same = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.lag(s).over(inner)) for s in state])
    df = rows.select(*columns, month)
    df = df.select("*", F.when(same & F.lag(F.lit(True), 1, False).over(inner), 0).otherwise(1).alias("_starts"), (~F.col(day).eqNullSafe(F.lag(day).over(inner))).alias("_other_day"))
    df = df.withColumn("_local", F.sum("_starts").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    new_day = F.col(day).isNotNull() & (F.col("_other_day") | (F.col("_starts") == 1))
    local = df.groupBy(*keys, "_month", "_local", *state).agg(F.min(day).alias("_from"), F.max(day).alias("_to"), F.count_if(new_day).alias("_days"), F.count("*").alias("_rows"))

    whole = F.struct(*state)
    months = local.groupBy(*keys, "_month").agg(F.max("_local").alias("_n"), F.min_by(whole, "_local").alias("_first"), F.max_by(whole, "_local").alias("_last"))
    outer = Window.partitionBy(*keys).orderBy("_month")
    joins = F.coalesce(F.lag("_last").over(outer).isNotNull() & F.col("_first").eqNullSafe(F.lag("_last").over(outer)), F.lit(False)).cast("int")
    months = months.select(*keys, "_month", "_n", joins.alias("_joins"))
    before = F.coalesce(F.sum(F.col("_n") - F.col("_joins")).over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    months = months.select(*keys, "_month", (before - F.col("_joins")).alias("_offset"))
    numbered = local.join(months, [*keys, "_month"]).withColumn("island", F.col("_local") + F.col("_offset"))
    return numbered.groupBy(*keys, "island", *state).agg(F.min("_from").alias("date_from"), F.max("_to").alias("date_to"), F.sum("_days").alias("observed_dates"), F.sum("_rows").alias("row_count"))


def associations(rows: DataFrame) -> DataFrame:
    """isin_n, symbol, series, island, date_from, date_to, observed_dates, row_count of every dated association of a keyed, non-overlay row."""
    found = runs(rows, ["isin_n"], ["trade_date", "source_line_number", "row_id"], ["symbol", "series"])
    return found.select("isin_n", "island", "symbol", "series", "date_from", "date_to", "observed_dates", "row_count")


def ticker_intervals(rows: DataFrame) -> DataFrame:
    """identity, series, ticker, island, date_from, date_to: runs of a ticker under one identity and series."""
    found = runs(rows, ["identity", "series"], ["trade_date", "file_name", "source_line_number", "row_id"], ["ticker"])
    return found.select("identity", "series", "island", "ticker", "date_from", "date_to")


def ambiguous(census: DataFrame) -> DataFrame:
    """identity, series of the groups one of whose tickers is shared by identities or overlaps another ticker of the group."""
    own = census.where("identity is not null").select("identity", "series", "ticker").distinct()
    shared = own.join(shared_tickers(census).select("ticker", "series"), ["ticker", "series"], "left_semi").select("identity", "series")
    return shared.unionByName(overlapping_tickers(census).select("identity", "series")).distinct()


def transitions(intervals: DataFrame, ordinals: DataFrame, unclear: DataFrame | None = None) -> DataFrame:
    """identity, series, from_ticker, to_ticker, ended, began, gap, kind: successive intervals and the file days between them.

    `ordinals` (trade_date, ordinal) numbers the days that have a file; a gap of 0 is the same day
    (kind SAME_DAY), 1 the next file day (SEQUENCE). Groups in `unclear` (identity, series) have none.
    """
    if unclear is not None:
        intervals = intervals.join(unclear, ["identity", "series"], "left_anti")
    w = Window.partitionBy("identity", "series").orderBy("island")  # a row an interval
    nxt = intervals.select(
        "identity", "series", F.col("ticker").alias("from_ticker"), F.col("date_to").alias("ended"), F.lead("ticker").over(w).alias("to_ticker"), F.lead("date_from").over(w).alias("began")
    ).where("began is not null")
    a = ordinals.select(F.col("trade_date").alias("ended"), F.col("ordinal").alias("_a"))
    b = ordinals.select(F.col("trade_date").alias("began"), F.col("ordinal").alias("_b"))
    gap = F.col("_b") - F.col("_a")
    kind = F.when(gap == 0, "SAME_DAY").otherwise("SEQUENCE")
    return nxt.join(a, "ended").join(b, "began").select("identity", "series", "from_ticker", "to_ticker", "ended", "began", gap.alias("gap"), kind.alias("kind"))


def day_ordinals(days: DataFrame) -> DataFrame:
    """trade_date, ordinal (from 1) of every distinct day: numbered within each year, plus the days of the years before."""
    distinct = days.select("trade_date").where("trade_date is not null").distinct().withColumn("_year", F.year("trade_date"))
    years = distinct.groupBy("_year").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)  # a row a year
    years = years.select("_year", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_year").orderBy("trade_date"))
    return distinct.withColumn("_at", within).join(years, "_year").select("trade_date", (F.col("_before") + F.col("_at")).cast("int").alias("ordinal"))


def ticker_census(rows: DataFrame) -> DataFrame:
    """ticker, series, identity, raw_symbol, date_from, date_to: bounds only where the identity is known."""
    known = F.col("identity").isNotNull()
    return rows.where("ticker is not null").groupBy("ticker", "series", "identity", F.col("symbol").alias("raw_symbol")).agg(
        F.min(F.when(known, F.col("trade_date"))).alias("date_from"), F.max(F.when(known, F.col("trade_date"))).alias("date_to")
    )


def merge_census(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Two censuses as one: least and greatest bounds of each observation."""
    return base.unionByName(delta).groupBy("ticker", "series", "identity", "raw_symbol").agg(F.min("date_from").alias("date_from"), F.max("date_to").alias("date_to"))


def shared_tickers(census: DataFrame) -> DataFrame:
    """ticker, series, identities of tickers under more than one known identity."""
    return census.groupBy("ticker", "series").agg(F.countDistinct("identity").alias("identities")).where("identities > 1")


def overlapping_tickers(census: DataFrame) -> DataFrame:
    """identity, series, ticker_1, ticker_2 of two tickers of one identity and series whose bounds overlap, the boundary day included.

    One row a ticker first, so the pairs of an identity are pairs of its few distinct tickers.
    """
    spans = census.where("identity is not null").groupBy("identity", "series", "ticker").agg(F.min("date_from").alias("s"), F.max("date_to").alias("e"))
    a = spans.select("identity", "series", F.col("ticker").alias("ticker_1"), F.col("s").alias("s1"), F.col("e").alias("e1"))
    b = spans.select("identity", "series", F.col("ticker").alias("ticker_2"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    return a.join(b, ["identity", "series"]).where("ticker_1 < ticker_2 and s1 <= e2 and s2 <= e1").select("identity", "series", "ticker_1", "ticker_2")


def within(point: Column, start: Column, end: Column) -> Column:
    return (point >= start) & (point <= end)


def associations_with_tickers(assoc: DataFrame, census: DataFrame) -> DataFrame:
    """Associations with the sorted tickers observed under them: a census bound lies in the association's interval."""
    o = census.select(F.col("identity").alias("_i"), F.col("series").alias("_s"), F.col("raw_symbol").alias("_r"), "ticker", F.col("date_from").alias("_f"), F.col("date_to").alias("_t"))
    hit = within(F.col("_f"), F.col("date_from"), F.col("date_to")) | within(F.col("_t"), F.col("date_from"), F.col("date_to"))
    on = (F.col("isin_n") == F.col("_i")) & (F.col("series") == F.col("_s")) & (F.col("symbol") == F.col("_r")) & hit
    keys = assoc.columns
    return assoc.join(o, on, "left").groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("ticker")), ",").alias("tickers"))


def link_overlays(rows: DataFrame, tokens: tuple[str, ...], by: str = "isin_n") -> DataFrame:
    """Overlay rows with the first base row of the same member and `by` in line order, and how many there are. Blank keys never join."""
    is_overlay = F.coalesce(F.col("series").isin(*tokens), F.lit(False))
    w = Window.partitionBy("member_id", by).orderBy("source_line_number", "row_id")
    base = rows.where(~is_overlay & F.col(by).isNotNull() & (F.col(by) != "")).select(
        "member_id", by, F.col("symbol").alias("base_symbol"), F.col("series").alias("base_series"), F.col("source_line_number").alias("base_line"), F.col("quantity").alias("base_quantity"),
        F.row_number().over(w).alias("_n"), F.count("*").over(Window.partitionBy("member_id", by)).alias("candidates"),
    ).where("_n = 1").drop("_n")
    linked = rows.where(is_overlay).join(base, ["member_id", by], "left")
    return linked.withColumn("relation", compare_quantities(F.col("quantity"), F.col("base_quantity")))


def compare_quantities(overlay: Column, base: Column) -> Column:
    return F.when(overlay.isNull() | base.isNull(), "unknown").when(overlay < base, "lt").when(overlay == base, "eq").otherwise("gt")
