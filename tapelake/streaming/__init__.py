"""Structured Streaming forms of the incremental operators: an extension beyond batch intake."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def windowed_counts(events: DataFrame, time: str, keys: list[str], window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window and key; rows later than `late` are dropped by the watermark."""
    g = events.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("window_start"), *keys, "n")


def each_batch(stream: DataFrame, fold: Callable[[DataFrame, int], None], checkpoint: str):
    """Run `fold(batch, id)` on every micro-batch of what is there, then stop."""
    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _changes(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last = state.get[0] if state.exists else None
    rows = []
    pdf = pd.concat(list(frames)).sort_values(["at", "seq"], kind="stable")
    for at, value in zip(pdf["at"], pdf["state"]):
        if value != last:
            rows.append((*key, at, last, value))
            last = value
    state.update((last,))
    yield pd.DataFrame(rows, columns=["key", "at", "before", "state"])


def state_changes(stream: DataFrame) -> DataFrame:
    """key, at, before, state whenever the state of a key changes; input key string, at timestamp, seq bigint, state string.

    One small state a key; rows of a micro-batch are ordered, rows of an earlier time in a later batch are taken as they come.
    """
    return stream.groupBy("key").applyInPandasWithState(_changes, "key string, at timestamp, before string, state string", "last string", "append", GroupStateTimeout.NoTimeout)
