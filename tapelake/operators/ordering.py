"""The row before, or the next value, in an order, without meeting a hot key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, key: str, chunk: Column, order: list[str], values: list[str]) -> DataFrame:
    """`df` with struct `previous` of `values` of the row before it within `key`, null for the first.

    `chunk` must rise with `order`. Rows are ordered within (key, chunk) only; what crosses a
    chunk's border is the last row of each chunk, one narrow row a chunk, handed to the first row
    of the next. A null key is a key; nulls sort first.
    """
    df = df.withColumn("_chunk", F.coalesce(chunk.cast("bigint"), F.lit(-(1 << 62))))
    inner = Window.partitionBy(key, "_chunk").orderBy(*order)
    df = df.select("*", F.lag(F.struct(*values)).over(inner).alias("_before"), F.row_number().over(inner).alias("_place"))
    ends = df.groupBy(key, "_chunk").agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_end"))
    outer = Window.partitionBy(key).orderBy("_chunk")
    handed = ends.select(F.col(key).alias("_key"), F.col("_chunk").alias("_to"), F.lag("_end").over(outer).alias("_handed")).where("_handed is not null")
    # Only first rows of chunks look at what was handed over.
    on = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_to")) & (F.col("_place") == 1)
    return df.join(handed, on, "left").withColumn("previous", F.coalesce("_before", "_handed")).drop("_chunk", "_before", "_place", "_key", "_to", "_handed")


def with_following(df: DataFrame, key: str, chunk: Column, order: list[str], value: str) -> DataFrame:
    """`df` with `following`: the first value of `value` that is not null at or after the row within `key`, however far away.

    `chunk` must rise with `order` and be null nowhere. A chunk hands its first value to the chunks
    before it, one narrow row a chunk. A null key is a key; where nothing follows the result is null.
    """
    df = df.withColumn("_chunk", chunk.cast("bigint"))
    inner = Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    df = df.withColumn("_after", F.first(value, ignorenulls=True).over(inner))
    heads = df.groupBy(key, "_chunk").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_head"))
    outer = Window.partitionBy(key).orderBy("_chunk").rowsBetween(1, Window.unboundedFollowing)
    handed = heads.select(F.col(key).alias("_key"), F.col("_chunk").alias("_to"), F.first("_head", ignorenulls=True).over(outer).alias("_handed")).where("_handed is not null")
    on = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_to"))
    return df.join(handed, on, "left").withColumn("following", F.coalesce("_after", "_handed")).drop("_chunk", "_after", "_key", "_to", "_handed")
