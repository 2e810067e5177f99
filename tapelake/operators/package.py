"""Packages of partitioned tables: manifest, completion marker last, verification, comparison, qualification of a replay.

The content hash of a table is a sum of row hashes, so it does not depend on order or layout and
merges over partitions.
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import canonical, exists, fingerprint, is_empty, read_document, write_document

MARKER = "_COMPLETE.json"


def content_state(df: DataFrame, by: list[str]) -> DataFrame:
    """`by`, row_count, digest: an order-free hash of the rows of each group."""
    columns = sorted(c for c in df.columns if c not in by)
    row = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c).cast("string"))])
    return df.groupBy(*by).agg(F.count("*").alias("row_count"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("digest"))


def _bindings(manifest: DataFrame, rows: DataFrame) -> dict:
    """What the marker says about the rest: partitions, rows, digest of the manifest, fingerprint of the schema."""
    one = manifest.agg(F.count("*").alias("partitions"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")).first()
    listed = content_state(manifest.select(*[F.col(c).cast("string").alias(c) for c in manifest.columns]), []).first()
    return {"partitions": one["partitions"], "row_count": one["row_count"], "manifest": f"{listed['row_count']}:{listed['digest']}", "schema": fingerprint(sorted([n, t] for n, t in rows.dtypes))}


def write_package(df: DataFrame, path: str, by: list[str], run_id: str | None = None, revision: str | None = None) -> dict:
    """Write `df` partitioned by `by` with a manifest; the marker is written last, so its absence means incomplete."""
    spark = df.sparkSession
    if not is_empty(spark, path):
        raise FileExistsError(path)
    df.repartition(*by).write.partitionBy(*by).parquet(f"{path}/rows")
    written = spark.read.parquet(f"{path}/rows")
    content_state(written, by).coalesce(1).write.parquet(f"{path}/manifest")  # a row a partition
    said = _bindings(spark.read.parquet(f"{path}/manifest"), written)
    write_document(spark, f"{path}/{MARKER}", {"by": by, "run_id": run_id, "revision": revision, **said})
    return {k: said[k] for k in ("partitions", "row_count")}


def atomic_json(path: str, document: dict) -> None:
    """Write canonical JSON of a document that only the driver keeps, and move it into place."""
    with open(f"{path}.new", "w", encoding="utf-8") as f:
        f.write(canonical(document))
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{path}.new", path)


def load_json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def verify_package(spark: SparkSession, path: str) -> DataFrame:
    """kind and partition of every difference between manifest and rows, in both directions; empty if the package holds."""
    by = read_document(spark, f"{path}/{MARKER}")["by"]
    said = spark.read.parquet(f"{path}/manifest")
    return compare(said, content_state(spark.read.parquet(f"{path}/rows"), by), by)


def compare(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Groups that only one state has, or whose content differs."""
    left, right = (df.select(*[F.col(c).cast("string").alias(f"{n}{c}") for c in by], F.struct("row_count", "digest").alias(n)) for df, n in ((a, "_a"), (b, "_b")))
    same = reduce(lambda x, y: x & y, [F.col(f"_a{c}").eqNullSafe(F.col(f"_b{c}")) for c in by]) if by else F.lit(True)
    kind = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unlisted").when(F.col("_a") != F.col("_b"), "different")
    return left.join(right, same, "full").select(kind.alias("kind"), *[F.coalesce(f"_a{c}", f"_b{c}").alias(c) for c in by]).where("kind is not null")


def open_package(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """The rows of a complete package; raises if it is incomplete or fails verification."""
    if not exists(spark, f"{path}/{MARKER}"):
        raise FileNotFoundError(f"{path} is not complete")
    if verify and (bad := verify_package(spark, path).limit(1).collect()):
        raise ValueError(f"{path} does not match its manifest: {bad[0].asDict()}")
    return spark.read.parquet(f"{path}/rows")


def open_partition(spark: SparkSession, path: str, **values) -> DataFrame:
    """The rows of one partition, verified on access: only its files are read and hashed."""
    by = read_document(spark, f"{path}/{MARKER}")["by"]
    where = " and ".join(f"`{c}` <=> {values[c]!r}" for c in by)
    rows = spark.read.parquet(f"{path}/rows").where(where)
    if bad := compare(spark.read.parquet(f"{path}/manifest").where(where), content_state(rows, by), by).limit(1).collect():
        raise ValueError(f"{path} does not match its manifest: {bad[0].asDict()}")
    return rows


def qualify_replay(spark: SparkSession, a: str, b: str) -> DataFrame:
    """gate, gating, result (pass, fail, not-run), detail: whether package `b` is a replay of `a`.

    RQ-01, 02 each package holds; RQ-03 to 07 both declare the same partitioning, schema, revision,
    partitions and rows; RQ-08 the markers bind their manifests and schemas; RQ-09, 10 each names
    its run; RQ-11 the runs are two; RQ-12 a revision is recorded (does not gate); RQ-13 the
    contents are equal, compared only if all gates before it passed.
    """
    out: list[tuple[str, bool, str, str]] = []
    gate = lambda n, ok, detail="", gating=True: out.append((f"RQ-{n:02d}", gating, "pass" if ok else "fail", str(detail)))
    marks, held = [], []
    for n, path in ((1, a), (2, b)):
        try:
            marks.append(read_document(spark, f"{path}/{MARKER}"))
            held.append(not verify_package(spark, path).limit(1).collect())
            gate(n, held[-1], path)
        except (FileNotFoundError, ValueError) as e:
            marks.append({})
            held.append(False)
            gate(n, False, e)
    x, y = marks
    for n, key in ((3, "by"), (4, "schema"), (5, "revision"), (6, "partitions"), (7, "row_count")):
        gate(n, bool(x) and bool(y) and x.get(key) == y.get(key), key)
    bound = all(held) and all({k: m[k] for k in said} == said for m, p in zip(marks, (a, b)) for said in [_bindings(spark.read.parquet(f"{p}/manifest"), spark.read.parquet(f"{p}/rows"))])
    gate(8, bound, "markers")
    gate(9, bool(x.get("run_id")), x.get("run_id"))
    gate(10, bool(y.get("run_id")), y.get("run_id"))
    gate(11, bool(x.get("run_id")) and x.get("run_id") != y.get("run_id"), "two runs")
    gate(12, bool(x.get("revision")) and bool(y.get("revision")), "recorded", False)
    if all(r == "pass" for _, gating, r, _ in out if gating):
        state = lambda p: content_state(spark.read.parquet(f"{p}/rows"), x["by"])
        gate(13, not compare(state(a), state(b), x["by"]).limit(1).collect(), "contents")
    else:
        out.append(("RQ-13", True, "not-run", "a gate before it failed"))
    return spark.createDataFrame(out, "gate string, gating boolean, result string, detail string")
