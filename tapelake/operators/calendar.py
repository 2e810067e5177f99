"""Trading calendar: a dense spine of days with what is known about each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def spine(days: DataFrame, column: str = "trade_date") -> DataFrame:
    """Every day from the first to the last, both included; empty for no days."""
    return days.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("trade_date"))


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(day) + 1)


def calendar(files: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """trade_date, weekday, file_present, formats, members, missing_weekday, label of every day of the span.

    `files` has trade_date, family, file_name; `holidays` trade_date, holiday. A missing weekday is
    labelled by its holiday; without one it is unexplained after the last legacy day, and not retrieved up to it.
    """
    per = files.where("trade_date is not null").groupBy("trade_date").agg(F.array_join(F.array_sort(F.collect_set("family")), ",").alias("formats"), F.count("*").alias("members"))
    days = spine(files).join(per, "trade_date", "left")
    last = files.where("family = 'legacy13'").agg(F.max("trade_date").alias("last_legacy"))
    if holidays is None:
        days = days.withColumn("holiday", F.lit(None).cast("string"))
    else:
        days = days.join(holidays.groupBy("trade_date").agg(F.min("holiday").alias("holiday")), "trade_date", "left")
    days = days.join(F.broadcast(last))  # one row
    present = F.col("members").isNotNull()
    missing = ~present & (F.weekday("trade_date") < 5)
    label = (
        F.when(F.col("holiday").isNotNull(), "official-holiday").when(present, "not-applicable").when(~missing, "weekend")
        .when(F.col("last_legacy").isNull() | (F.col("trade_date") <= F.col("last_legacy")), "not-retrieved").otherwise("unexplained")
    )
    return days.select("trade_date", weekday_name(F.col("trade_date")).alias("weekday"), present.alias("file_present"), "formats", F.coalesce("members", F.lit(0)).alias("members"),
        missing.alias("missing_weekday"), label.alias("label"))


def arithmetic_closes(cal: DataFrame) -> DataFrame:
    """One row: days, weekdays, days with file, missing weekdays, weekend files, and whether they add up."""
    weekday = F.weekday("trade_date") < 5
    one = cal.agg(
        F.count("*").alias("days"), F.count_if(weekday).alias("weekdays"), F.count_if("file_present").alias("file_days"),
        F.count_if("missing_weekday").alias("missing_weekdays"), F.count_if(F.col("file_present") & ~weekday).alias("weekend_files"),
    )
    return one.withColumn("closes", F.col("weekdays") == F.col("file_days") - F.col("weekend_files") + F.col("missing_weekdays"))


def arithmetic_by_label(cal: DataFrame) -> DataFrame:
    return cal.groupBy("label").agg(F.count("*").alias("days"))
