"""Small documents beside tables, on whatever file system the path names; written and moved by the driver."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def is_empty(spark: SparkSession, path: str) -> bool:
    """True for a missing path too."""
    fs, p = _at(spark, path)
    return not fs.exists(p) or len(fs.listStatus(p)) == 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target and move into place, over what is there."""
    fs, p = _at(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
        out.hflush()
    finally:
        out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(fresh), context.makeQualified(p), options)


def canonical(document: dict) -> str:
    """JSON with sorted keys, compact, without NaN."""
    return json.dumps(document, sort_keys=True, separators=(",", ":"), allow_nan=False, ensure_ascii=False)


def fingerprint(document: dict | list) -> str:
    return hashlib.sha256(canonical(document).encode()).hexdigest()


def write_document(spark: SparkSession, path: str, document: dict) -> str:
    """Write canonical JSON and its digest beside it (`path`.sha256, first); returns the digest."""
    digest = fingerprint(document)
    write_text(spark, f"{path}.sha256", digest)
    write_text(spark, path, canonical(document))
    return digest


def read_document(spark: SparkSession, path: str, verify: bool = True) -> dict:
    """A document; with `verify` its digest must be there and hold."""
    text = read_text(spark, path)
    if verify and read_text(spark, f"{path}.sha256").strip() != hashlib.sha256(text.encode()).hexdigest():
        raise ValueError(f"{path} does not match its digest")
    return json.loads(text)
