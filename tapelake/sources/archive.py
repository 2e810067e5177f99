"""ZIP archives with one CSV member each, read strictly.

An archive is opaque bytes; one task reads one archive. A member that breaks a rule of the whole
file (byte order mark, invalid UTF-8, lone carriage return, empty, unknown header, more or fewer
than one CSV) is reported with its reason and has no lines; broken lines of a good member are
left to the quarantine operator.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import LEGACY, UDIFF

LINES = "relative_path string, member_name string, detected_format string, header_width int, line_number int, raw_line string"
REPORT = (
    "relative_path string, member_name string, archive_sha256 string, member_sha256 string, member_sha256_lf string, detected_format string, header_width int, "
    "data_lines bigint, crlf_lines bigint, size_bytes bigint, failure string"
)
_HEADERS = {
    tuple(n for n, _ in LEGACY): ("legacy13", 13),
    (*(n for n, _ in LEGACY), ""): ("legacy13", 14),
    tuple(n for n, _ in UDIFF): ("udiff34", 34),
}


def header_variant(line: str) -> tuple[str, int] | None:
    """(format, width) of a header line, matched by exact names."""
    return _HEADERS.get(tuple(line.split(",")))


def split_lines(text: str) -> list[str]:
    """Lines of a member: CRLF counts as LF and one final line end is dropped."""
    lines = text.replace("\r\n", "\n").split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def read_member(archive: bytes) -> tuple[dict, list[str]]:
    """(report of the archive's only CSV member, its data lines); `failure` says why there are none."""
    report = {"member_name": None, "archive_sha256": hashlib.sha256(archive).hexdigest(), "member_sha256": None, "member_sha256_lf": None, "detected_format": None, "header_width": None,
        "data_lines": 0, "crlf_lines": 0, "size_bytes": len(archive), "failure": None}
    try:
        with zipfile.ZipFile(io.BytesIO(archive)) as z:
            names = [n for n in z.namelist() if n.lower().endswith(".csv")]
            if len(names) != 1:
                return report | {"failure": "not_exactly_one_csv"}, []
            data = z.read(names[0])
    except (zipfile.BadZipFile, RuntimeError, NotImplementedError):
        return report | {"failure": "unreadable_archive"}, []
    lf = data.replace(b"\r\n", b"\n")
    report |= {"member_name": names[0], "member_sha256": hashlib.sha256(data).hexdigest(), "member_sha256_lf": hashlib.sha256(lf).hexdigest(), "crlf_lines": data.count(b"\r\n")}
    if not data:
        return report | {"failure": "empty_member"}, []
    if data.startswith(b"\xef\xbb\xbf"):
        return report | {"failure": "byte_order_mark"}, []
    if b"\r" in lf:
        return report | {"failure": "lone_carriage_return"}, []
    try:
        lines = split_lines(data.decode("utf-8"))
    except UnicodeDecodeError:
        return report | {"failure": "invalid_utf8"}, []
    variant = header_variant(lines[0])
    if variant is None:
        return report | {"failure": "unknown_header"}, []
    return report | {"detected_format": variant[0], "header_width": variant[1], "data_lines": len(lines) - 1}, lines[1:]


def archives(spark: SparkSession, path: str) -> DataFrame:
    """relative_path, content of every *.zip below `path`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", rf"^.*?\Q{path.rstrip('/')}\E/(.*)\z", 1).alias("relative_path"), "content")


def member_reports(files: DataFrame) -> DataFrame:
    """One row an archive: hashes, header variant, line counts, or the reason it can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{"relative_path": p} | read_member(c)[0] for p, c in zip(pdf.relative_path, pdf.content)]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in REPORT.split(", ")])

    return files.mapInPandas(run, REPORT)


def member_lines(files: DataFrame, at_once: int = 50_000) -> DataFrame:
    """Every data line of every readable member, numbered as in the file (the header is line 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf.relative_path, pdf.content):
                report, lines = read_member(content)
                for k in range(0, len(lines), at_once):
                    part = lines[k : k + at_once]
                    yield pd.DataFrame({"relative_path": path, "member_name": report["member_name"], "detected_format": report["detected_format"], "header_width": report["header_width"],
                        "line_number": range(k + 2, k + 2 + len(part)), "raw_line": part})

    return files.mapInPandas(run, LINES)


class _Archive(InputPartition):
    def __init__(self, path: str, relative: str):
        super().__init__(path)
        self.path, self.relative = path, relative


class _Reader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self):
        from pathlib import Path

        root = Path(self.root)
        return [_Archive(str(p), str(p.relative_to(root))) for p in sorted(root.rglob("*.zip"))]

    def read(self, partition):
        with open(partition.path, "rb") as f:
            report, lines = read_member(f.read())
        for k, line in enumerate(lines, 2):
            yield (partition.relative, report["member_name"], report["detected_format"], report["header_width"], k, line)


class ZipMembers(DataSource):
    """`spark.read.format("zipmembers").load(folder)`: the lines of all archives of a shared folder, one partition an archive."""

    @classmethod
    def name(cls) -> str:
        return "zipmembers"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def dated_files(paths: DataFrame) -> DataFrame:
    """`paths` with file_date from the name: cmDDMMMYYYY..., or ..._YYYYMMDD...; null if there is none."""
    name = F.element_at(F.split("relative_path", "/"), -1)
    old = F.try_to_date(F.initcap(F.regexp_extract(name, r"(?i)cm(\d{2}[a-z]{3}\d{4})", 1)), "ddMMMyyyy")
    new = F.try_to_date(F.regexp_extract(name, r"_(\d{8})[_.]", 1), "yyyyMMdd")
    return paths.withColumn("file_date", F.coalesce(old, new))
