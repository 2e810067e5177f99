"""Incremental intake: arrivals classified, drafts, generations published and read as snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..files import exists, fingerprint, read_document, write_document
from .package import MARKER, content_state, open_package, write_package

POINTER = "CURRENT.json"
#: Rows and bytes that one draft may publish.
MOST_ROWS, MOST_BYTES = 20_000, 128 << 20


def classify(arrivals: DataFrame, accepted: DataFrame) -> DataFrame:
    """`arrivals` (path, name, date, digest, ...) with `state`, the first that applies.

    dup_path: the path is offered more than once; unchanged: same name and date, same digest;
    conflict: same name and date, other digest; dup_content: the digest is accepted under another
    name; stale: dated before the last accepted day; else new.
    """
    by_name = accepted.groupBy("name", "date").agg(F.min("digest").alias("_known"))
    by_digest = accepted.where("digest is not null").groupBy("digest").agg(F.count("*").alias("_copies"))
    last = accepted.agg(F.max("date").alias("_last"))
    a = arrivals.withColumn("_n", F.count("*").over(Window.partitionBy("path")))
    a = a.join(by_name, ["name", "date"], "left").join(by_digest, "digest", "left").join(F.broadcast(last))  # one row
    state = (
        F.when(F.col("_n") > 1, "dup_path").when(F.col("_known") == F.col("digest"), "unchanged").when(F.col("_known").isNotNull(), "conflict")
        .when(F.col("_copies").isNotNull(), "dup_content").when(F.col("date") < F.col("_last"), "stale").otherwise("new")
    )
    return a.withColumn("state", state).select(*arrivals.columns, "state")


def stageable(reports: DataFrame, expected: DataFrame, quarantined: DataFrame) -> DataFrame:
    """`reports` of members (relative_path, failure, ...) with `refusal`, the first that applies, null if the archive may be staged.

    unreadable: the archive has no single CSV member that reads; undated: no day is `expected`
    (relative_path, file_date) of it; several_dates: more than one is; quarantined: a line of it
    failed (relative_path in `quarantined`).
    """
    days = expected.where("file_date is not null").groupBy("relative_path").agg(F.countDistinct("file_date").alias("_days"))
    bad = quarantined.select("relative_path").distinct().withColumn("_bad", F.lit(True))
    j = reports.join(days, "relative_path", "left").join(bad, "relative_path", "left")
    refusal = F.when(F.col("failure").isNotNull(), "unreadable").when(F.col("_days").isNull(), "undated").when(F.col("_days") > 1, "several_dates").when(F.col("_bad"), "quarantined")
    return j.withColumn("refusal", refusal).select(*reports.columns, "refusal")


def log_conflicts(log: DataFrame, conflicts: DataFrame, keys: list[str]) -> DataFrame:
    """The log with conflicts it does not hold yet: the first seen stays."""
    return log.unionByName(conflicts.dropDuplicates(keys).join(log.select(*keys), keys, "left_anti").select(*log.columns))


def refresh(base: DataFrame, delta: DataFrame, old_result: DataFrame, keys: list[str], compute, linked: DataFrame | None = None) -> DataFrame:
    """`compute` over base and delta, done again only for the keys that the delta touches and those in `linked`; other results are kept.

    `linked` are keys whose result depends on other keys' new rows, such as identities that share a
    newly seen ticker (`sharing`).
    """
    touched = delta.select(*keys)
    touched = (touched if linked is None else touched.unionByName(linked.select(*keys))).distinct()
    again = compute(base.join(touched, keys, "left_semi").unionByName(delta))
    return old_result.join(touched, keys, "left_anti").unionByName(again)


def sharing(base: DataFrame, delta: DataFrame, key: str, label: list[str]) -> DataFrame:
    """Keys of `base` that carry a `label` which the delta brings to a key that did not have it."""
    pair = [key, *label]
    fresh = delta.select(*pair).distinct().join(base.select(*pair).distinct(), pair, "left_anti").select(*label).distinct()
    return base.select(*pair).distinct().join(fresh, label, "left_semi").select(key).distinct()


# ---- generations


def publish(df: DataFrame, root: str, by: list[str], run_id: str | None = None) -> int:
    """Write a new generation and move the pointer to it; readers of older generations are not disturbed."""
    spark = df.sparkSession
    number = (current(spark, root) or 0) + 1
    write_package(df, f"{root}/generation-{number:06d}", by, run_id)
    write_document(spark, f"{root}/{POINTER}", {"generation": number})
    return number


def publish_derived(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, list[str]]]) -> dict:
    """Write derived tables (name to frame and partition columns) as packages under one root; the root's marker, which lists them, comes last."""
    said = {name: write_package(df, f"{root}/{name}", by) for name, (df, by) in sorted(tables.items())}
    write_document(spark, f"{root}/{MARKER}", {"tables": said})
    return said


def current(spark: SparkSession, root: str) -> int | None:
    return read_document(spark, f"{root}/{POINTER}")["generation"] if exists(spark, f"{root}/{POINTER}") else None


def snapshot(spark: SparkSession, root: str, generation: int | None = None) -> DataFrame:
    """The rows of one generation, resolved once."""
    number = generation or current(spark, root)
    if number is None or not exists(spark, f"{root}/generation-{number:06d}/{MARKER}"):
        raise FileNotFoundError(f"no generation {number} in {root}")
    return spark.read.parquet(f"{root}/generation-{number:06d}/rows")


# ---- drafts


def create_draft(delta: DataFrame, root: str, by: list[str]) -> str:
    """Write the delta alone under a name made from its content, and from the generation it builds on; the same draft twice is one."""
    spark = delta.sparkSession
    state = content_state(delta, []).first()
    name = fingerprint([current(spark, root), sorted(delta.dtypes), state["row_count"], state["digest"]])
    if not exists(spark, f"{root}/drafts/{name}/{MARKER}"):
        write_package(delta, f"{root}/drafts/{name}", by)
        write_document(spark, f"{root}/drafts/{name}.json", {"base": current(spark, root), "by": by})
    return name


def publish_draft(spark: SparkSession, root: str, draft: str, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> int:
    """Publish a draft on top of the generation it was made for: both are verified, then composed.

    Refused (ValueError) if the pointer has moved since, or the draft has more rows or bytes of
    text than one publication may have.
    """
    about = read_document(spark, f"{root}/drafts/{draft}.json")
    if about["base"] != current(spark, root):
        raise ValueError(f"{draft} was made for generation {about['base']}")
    delta = open_package(spark, f"{root}/drafts/{draft}")
    size = delta.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")).first()
    if size["rows"] > most_rows or size["bytes"] > most_bytes:
        raise ValueError(f"{draft} has {size['rows']} rows and {size['bytes']} bytes")
    if about["base"] is None:
        return publish(delta, root, about["by"], draft)
    base = open_package(spark, f"{root}/generation-{about['base']:06d}")
    return publish(base.unionByName(delta), root, about["by"], draft)
