"""Scans of documents that must be exactly what they claim: every drift of keys, order or digest is an error.

A scan reads its files once to check them, with aggregations only, and returns a lazy frame of the
declared schema. An absent file is an error unless the scan says that absence means no records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..files import exists
from ..operators.ordering import with_previous


class ScanError(ValueError):
    """A document that is not what its scan declares."""


def read_jsonl(spark: SparkSession, path: str, schema: str, ascending: str | None = None, unique: list[str] | None = None, missing_ok: bool = False) -> DataFrame:
    """One JSON object a line with exactly the keys of `schema` (a DDL string), typed as it says.

    `ascending`: a column that must rise strictly from line to line of a file. `unique`: columns
    whose values no two lines share. With `missing_ok` an absent path is an empty frame.
    """
    declared = StructType.fromDDL(schema)
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], declared)
    lines = spark.read.text(path).where(F.trim("value") != "")
    keys = F.array_sort(F.json_object_keys("value"))
    parsed = lines.select("value", keys.alias("_keys"), F.from_json("value", declared, {"mode": "PERMISSIVE"}).alias("_x"), F.monotonically_increasing_id().alias("_at"),
        F.col("_metadata.file_path").alias("_file"))
    wanted = F.array(*[F.lit(n) for n in sorted(declared.names)])
    # A value of another type is null where its text is not.
    lost = [F.col(f"_x.`{f.name}`").isNull() & F.get_json_object("value", f"$['{f.name}']").isNotNull() for f in declared.fields]
    bad = parsed.agg(F.count_if(F.col("_keys").isNull()).alias("broken"), F.count_if(F.col("_keys") != wanted).alias("keys"), *[F.count_if(c).alias(f"type_{i}") for i, c in enumerate(lost)]).first()
    if any(bad):
        raise ScanError(f"{path}: {bad['broken']} lines are no objects, {bad['keys']} have other keys, values of another type: {[(declared.names[i], bad[2 + i]) for i in range(len(lost)) if bad[2 + i]]}")
    df = parsed.select("_x.*", "_at", "_file")
    if ascending:
        before = with_previous(df, "_file", F.shiftright("_at", 33), ["_at"], [ascending])
        if n := before.where(F.col("previous").isNotNull() & ~F.coalesce(F.col(ascending) > F.col(f"previous.{ascending}"), F.lit(False))).count():
            raise ScanError(f"{path}: {ascending} does not rise at {n} lines")
    if unique and (n := df.groupBy(*unique).count().where("count > 1").count()):
        raise ScanError(f"{path}: {n} values of {', '.join(unique)} occur more than once")
    return df.drop("_at", "_file")


def pinned(spark: SparkSession, path: str, sha256: str, lines: int | None = None) -> str:
    """The path, if its bytes have the pinned digest and it has as many lines as said."""
    got = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("d")).collect()
    if [r["d"] for r in got] != [sha256.strip().lower()]:
        raise ScanError(f"{path} does not have the pinned digest")
    if lines is not None and (n := spark.read.text(path).where("trim(value) <> ''").count()) != lines:
        raise ScanError(f"{path} has {n} lines instead of {lines}")
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with exactly the header of `schema`, in its order; a value that does not parse is an error when it is read."""
    declared = StructType.fromDDL(schema)
    head = spark.read.option("header", False).csv(path).first()
    if head is None or [x for x in head] != declared.names:
        raise ScanError(f"{path}: header is {head and list(head)}")
    return spark.read.schema(declared).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)


def read_labels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(missing_date, label, circular, registry_id; holiday, bhav_file, note) of a label document; a circular of the registry is its own id."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", (
        "per_missing_day array<struct<missing_date:date,label:string,circular:string>>, holidays_with_file array<struct<holiday_per_circular:date,bhav_file:string,note:string>>"
    )).alias("d"))
    days = doc.select(F.explode("d.per_missing_day").alias("x")).select("x.*")
    days = days.withColumn("registry_id", F.when(F.col("circular").contains("/"), F.col("circular")))
    return days, doc.select(F.explode("d.holidays_with_file").alias("x")).select(F.col("x.holiday_per_circular").alias("holiday"), "x.bhav_file", "x.note")


def read_series_classes(spark: SparkSession, path: str) -> DataFrame:
    """series, class, basis as their producer names them: provisional_class and classification_basis."""
    df = spark.read.option("header", True).csv(path)
    if missing := {"series", "provisional_class", "classification_basis"} - set(df.columns):
        raise ScanError(f"{path} lacks {sorted(missing)}")
    return df.select("series", F.col("provisional_class").alias("class"), F.col("classification_basis").alias("basis"))
