"""Overlapping and gapped intervals: dyadic blocks, merged and coalesced.

Every interval of whole days is cut into canonical dyadic blocks (level l, start a multiple of
2^l), at most two a level. Equal blocks of a key collapse before the shuffle, which leaves at most
twice as many blocks as the calendar has days, however many rows a hot key has. Blocks inside an
ancestor are removed, sibling pairs are merged upward, and adjacent blocks coalesce into periods;
gaps lie between successive periods. All of it is window functions over one sort by (key, start):
blocks that no ancestor covers are disjoint, so the start alone orders them and stays as it is
while siblings merge.

Nulls: rows without key or first day, with bounds in wrong order or with a last day that is no
ISO date are left out; a null last day means the open end. Empty input gives an empty result.
Repeated rows change nothing. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_day
from ..functions.text import norm

#: Days from 0000-01-01 to 1970-01-01: with it, every date of the years 1..9999 is not negative.
ORIGIN = 719_528
#: Levels of sibling merging: 2^14 days are 44 years. A run that is longer still is more than one block then, and its blocks coalesce as neighbours, so no result depends on the number.
MERGE_LEVELS = 14


def dyadic_blocks(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """`df` with one row per canonical block of [lo, hi] (inclusive, not negative): columns level, start."""
    a, b = F.col(lo).cast("bigint"), F.col(hi).cast("bigint") + 1
    top = F.floor(F.log2((b - a).cast("double"))).cast("int") + 1

    def at(level):
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        first, last = F.call_function("shiftright", a + size - 1, level), F.call_function("shiftright", b, level)
        block = lambda index: F.struct(level.alias("level"), (index * size).alias("start"))
        return F.array(
            F.when((first < last) & (first % 2 == 1), block(first)),
            F.when((first < last) & (last % 2 == 1), block(last - 1)),
        )

    blocks = F.filter(F.flatten(F.transform(F.sequence(F.lit(0), top), at)), lambda x: x.isNotNull())
    return df.select("*", F.explode(blocks).alias("_b")).select("*", "_b.level", "_b.start").drop("_b")


def _size(level):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def periods(intervals: DataFrame, merge_levels: int = MERGE_LEVELS) -> DataFrame:
    """key, lo, hi: the continuous periods of `intervals` (key, lo, hi; whole numbers from 0, inclusive)."""
    w = Window.partitionBy("key").orderBy("start", F.desc("level"))
    blocks = dyadic_blocks(intervals, "lo", "hi").select("key", "level", "start").distinct()
    reach = F.max(F.col("start") + _size(F.col("level"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    free = blocks.withColumn("reach", reach).where("reach is null or reach < start + shiftleft(1L, level)").drop("reach")
    w = Window.partitionBy("key").orderBy("start")
    for level in range(merge_levels):
        size = 1 << level
        is_here = F.col("level") == level
        left = F.col("start") % (2 * size) == 0
        pair = free.select(
            "*",
            F.struct(F.lag("level").over(w).alias("level"), F.lag("start").over(w).alias("start")).alias("before"),
            F.struct(F.lead("level").over(w).alias("level"), F.lead("start").over(w).alias("start")).alias("after"),
        )
        absorbed = is_here & ~left & (F.col("before.level") == level) & (F.col("before.start") == F.col("start") - size)
        grows = is_here & left & (F.col("after.level") == level) & (F.col("after.start") == F.col("start") + size)
        free = pair.where(~F.coalesce(absorbed, F.lit(False))).select(
            "key", (F.col("level") + F.coalesce(grows, F.lit(False)).cast("int")).alias("level"), "start"
        )
    end = F.col("start") + _size(F.col("level"))
    islands = free.select("key", "start", end.alias("end"), F.lag(end).over(w).alias("before"))
    islands = islands.withColumn("island", F.sum(F.when(F.col("before") == F.col("start"), 0).otherwise(1)).over(w))
    return islands.groupBy("key", "island").agg(F.min("start").alias("lo"), (F.max("end") - 1).alias("hi")).drop("island")


def with_gaps(merged: DataFrame) -> DataFrame:
    """key, kind ('period' or 'gap'), lo, hi of disjoint, non-adjacent periods."""
    w = Window.partitionBy("key").orderBy("lo")
    both = merged.withColumn("next", F.lead("lo").over(w)).select(
        "key",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit("period").alias("kind"), F.col("lo"), F.col("hi")),
                    F.when(F.col("next").isNotNull(), F.struct(F.lit("gap").alias("kind"), (F.col("hi") + 1).alias("lo"), (F.col("next") - 1).alias("hi"))),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("x"),
    )
    return both.select("key", "x.*")


def ticker_periods(tickers: DataFrame, open_end: str = "2026-09-18") -> DataFrame:
    """identity, kind, date_from, date_to (ISO): continuous periods of every identity and the gaps between them."""
    hi = F.when(F.col("date_to").isNull(), F.lit(open_end).cast("date")).otherwise(iso_day(F.col("date_to")))
    rows = tickers.select(
        norm(F.col("identity")).alias("key"),
        (F.unix_date(iso_day(F.col("date_from"))) + ORIGIN).alias("lo"),
        (F.unix_date(hi) + ORIGIN).alias("hi"),
    ).where("key is not null and lo <= hi")
    day = lambda c: F.date_from_unix_date((F.col(c) - ORIGIN).cast("int")).cast("string")
    return with_gaps(periods(rows)).select(F.col("key").alias("identity"), "kind", day("lo").alias("date_from"), day("hi").alias("date_to"))
