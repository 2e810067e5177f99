"""New batches of files against all history: a stored, incremental prefix index of rare lines.

A file is the set of its lines. Two files match if their digests agree, or if the lines they
share are at least `threshold` of the distinct lines of both together. Files with equal sets form
one class. The lines of a class are ordered from rare to common, by counts frozen when the index
was built (a line unseen then is rarest), and the first ones, so many that any match must share
one of them, are its postings.

The index is a folder of tables, each partitioned by delivery and by bucket of its key: postings
and counts by line, sets and members by class, digests by digest. A delivery reads only the
buckets that its own lines, classes and digests fall into; the sets of old classes are fetched
only for survivors of the length and position filters; what is new is appended as files of its
own, and the mark `done` comes last, so a delivery that broke off is written over. The number of
buckets follows the size of the history (`ROWS_A_BUCKET`), so what a small batch reads stays the
same while history grows; `compact` does that anew and merges the files of many deliveries.

A hot line is spread by the size class in the join key and by adaptive skew splitting; classes
keep thousands of equal files from being compared with each other. Equal files and equal digests
are expanded into the pairs the result asks for only at the end; `links` gives the same matches
as class pairs and membership, without that step.

Nulls: a file without text has no lines and matches by digest only; a digest that is not 64 hex
digits equals nothing; a file with neither matches nothing. Rows with the same entry_id are one
file, the one with the greatest (lines, digest). Candidates without batch_no come first. Empty
tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import materialize, new_folder

THRESHOLD = Fraction(1, 2)
#: Postings a bucket should hold, and the bounds of the number of buckets.
ROWS_A_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1 << 16, 16, 1 << 14
#: Deliveries that `duplicates` makes of the batches at most: a delivery costs a dozen small jobs, whatever its size.
DELIVERIES = 3
TABLES = {
    "counts": "line bigint, seen bigint",
    "postings": "line bigint, class string, n int, at int",
    "sets": "class string, lines array<bigint>",
    "members": "class string, entry_id bigint, staged boolean",
    "digests": "digest string, entry_id bigint, staged boolean",
    "done": "buckets int",
    "found": "entry_id_1 bigint, entry_id_2 bigint",
    "links": "class_1 string, class_2 string",
}
KEYS = {"counts": "line", "postings": "line", "sets": "class", "members": "class", "digests": "digest"}


def clean_digest(c: Column) -> Column:
    """64 lower-case hex digits, else null."""
    x = F.regexp_replace(F.lower(strip(c)), r"^sha256:\s*", "")
    return F.when(x.rlike(r"^[0-9a-f]{64}\z"), x)


def distinct_lines(text: Column) -> Column:
    """Sorted hashes of the distinct lines: trimmed, one final comma dropped, empty ones ignored."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\r\n|\n|\r"), lambda x: F.regexp_replace(strip(x), r",\z", ""))
    return F.array_sort(F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x))))


def files(df: DataFrame, staged: bool) -> DataFrame:
    """entry_id, digest, lines, class (null without lines), staged. Texts become hashes before anything is shuffled."""
    slim = df.select("entry_id", F.struct(distinct_lines(F.col("row_text")).alias("lines"), clean_digest(F.col("digest")).alias("digest")).alias("x"))
    one = slim.groupBy("entry_id").agg(F.max("x").alias("x")).select("entry_id", "x.digest", "x.lines")
    name = F.when(F.size("lines") > 0, F.md5(F.array_join(F.transform("lines", lambda x: x.cast("string")), ",")))
    return one.select("entry_id", "digest", "lines", name.alias("class"), F.lit(staged).alias("staged"))


def line_counts(df: DataFrame) -> DataFrame:
    """line, seen: in how many files a line occurs, of lines in more than one."""
    return df.select(F.explode("lines").alias("line")).groupBy("line").agg(F.count("*").alias("seen")).where("seen > 1")


class PrefixIndex:
    """The index in a folder, as it stands after `deliveries` deliveries; the first is what it was built from."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, deliveries: int, threshold: Fraction = THRESHOLD):
        self.spark, self.path, self.buckets, self.deliveries, self.threshold = spark, path, buckets, deliveries, threshold

    # ---- storage

    def _bucket(self, key: Column, name: str) -> Column:
        return F.pmod(key if KEYS[name] == "line" else F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, name: str, touched: list[int] | None = None) -> DataFrame:
        """A table of the index, of the buckets `touched` only."""
        keyed = name in KEYS
        df = self.spark.read.schema(f"{TABLES[name]}, delivery int" + ", bucket int" * keyed).parquet(f"{self.path}/{name}").where(F.col("delivery") < self.deliveries)
        if keyed and touched is not None and len(touched) < self.buckets:
            df = df.where(F.col("bucket").isin(touched))
        return df.drop("delivery", "bucket")

    def _write(self, name: str, df: DataFrame) -> None:
        """Append `df` as the files of the next delivery."""
        out = df.select(*[c.split()[0] for c in TABLES[name].split(", ")])
        if name in KEYS:
            out = out.withColumn("bucket", self._bucket(F.col(KEYS[name]), name)).repartition("bucket")
        writer = out.write.mode("overwrite")
        (writer.partitionBy("bucket") if name in KEYS else writer).parquet(f"{self.path}/{name}/delivery={self.deliveries}")

    def _touched(self, df: DataFrame, name: str, keys: Column) -> list[int]:
        """The buckets of a table that the keys of `df` (an array column) fall into; at most `buckets` numbers."""
        numbers = df.select(F.explode(F.array_distinct(F.transform(keys, lambda x: self._bucket(x, name)))).alias("b")).distinct()
        return sorted(r["b"] for r in numbers.collect())

    # ---- building

    @staticmethod
    def build(accepted: DataFrame, path: str | None = None, threshold: Fraction = THRESHOLD, rows_a_bucket: int = ROWS_A_BUCKET) -> PrefixIndex:
        """Index of the accepted files; the line counts are frozen here."""
        spark = accepted.sparkSession
        df = materialize(files(accepted, False))
        lines = df.agg(F.sum(F.size("lines"))).first()[0] or 0
        wanted = 1 << max(0, math.ceil(math.log2(max(1, lines * float(1 - threshold) / rows_a_bucket))))
        index = PrefixIndex(spark, path or new_folder(spark), min(MOST_BUCKETS, max(LEAST_BUCKETS, wanted)), 0, threshold)
        counts = materialize(line_counts(df))
        index._write("counts", counts)
        return index._append(df, materialize(index._classes(df, counts)))

    @staticmethod
    def load(spark: SparkSession, path: str, threshold: Fraction = THRESHOLD) -> PrefixIndex:
        """The index as the last complete delivery left it."""
        last = spark.read.schema(f"{TABLES['done']}, delivery int").parquet(f"{path}/done").agg(F.max("delivery").alias("d"), F.max("buckets").alias("b")).first()
        return PrefixIndex(spark, path, last["b"], last["d"] + 1, threshold)

    def compact(self, path: str, rows_a_bucket: int = ROWS_A_BUCKET) -> PrefixIndex:
        """The same index in a new folder, as one delivery with as many buckets as it needs now."""
        rows = self.read("postings").count()
        wanted = 1 << max(0, math.ceil(math.log2(max(1, rows / rows_a_bucket))))
        new = PrefixIndex(self.spark, path, min(MOST_BUCKETS, max(LEAST_BUCKETS, wanted)), 0, self.threshold)
        for name in KEYS:
            new._write(name, self.read(name))
        return new._close()

    def _close(self) -> PrefixIndex:
        self._write("done", self.spark.range(1).select(F.lit(self.buckets).alias("buckets")))
        return PrefixIndex(self.spark, self.path, self.buckets, self.deliveries + 1, self.threshold)

    def _append(self, batch: DataFrame, classes: DataFrame) -> PrefixIndex:
        """The index with a batch of `files` and those of its classes that are new; the mark is written last."""
        self._write("postings", self.postings(classes))
        self._write("sets", classes)
        self._write("members", batch.where("class is not null"))
        self._write("digests", batch.where("digest is not null"))
        return self._close()

    @staticmethod
    def _classes(df: DataFrame, counts: DataFrame) -> DataFrame:
        """class, lines from rare to common, n of every distinct set."""
        unique = df.where("class is not null").groupBy("class").agg(F.min("lines").alias("lines"))
        tokens = unique.select("class", F.explode("lines").alias("line")).join(counts, "line", "left")
        ordered = tokens.groupBy("class").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "line"))).alias("ordered"))
        return ordered.select("class", F.transform("ordered", lambda t: t["line"]).alias("lines"), F.size("ordered").alias("n"))

    def _prefix(self, lines: Column) -> Column:
        """The first n - ceil(t * n) + 1 of n lines."""
        t = self.threshold
        need = F.floor((F.size(lines) * t.numerator + t.denominator - 1) / t.denominator).cast("int")
        return F.slice(lines, F.lit(1), F.size(lines) - need + 1)

    def postings(self, classes: DataFrame) -> DataFrame:
        """line, class, n, at of every prefix line."""
        return classes.select("class", "n", F.posexplode(self._prefix(F.col("lines"))).alias("at", "line"))

    # ---- probing

    def _met(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """class_x, class_y, old: classes that share a prefix line and could match by length and position; y is of the batch."""
        t = self.threshold
        band = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
        side = lambda p, x: p.select("line", *[F.col(c).alias(f"{c}_{x}") for c in ("class", "n", "at", "old")], "band")
        probes = new.withColumn("old", F.lit(False))
        # Sizes of a match differ by 1/threshold at most, so their powers of two do by its logarithm.
        reach = math.ceil(math.log2(1 / t))
        left = side(old.withColumn("old", F.lit(True)).unionByName(probes).withColumn("band", band), "x")
        right = side(probes.withColumn("band", F.explode(F.array(*[band + i for i in range(-reach, reach + 1)]))), "y")
        n, m = F.col("n_x"), F.col("n_y")
        fits = (n * t.denominator >= m * t.numerator) & (m * t.denominator >= n * t.numerator)
        # shared >= t/(1+t) * (n+m); what is left after the current positions bounds it.
        most = F.least(n - F.col("at_x"), m - F.col("at_y"))
        reachable = most * (t.numerator + t.denominator) >= (n + m) * t.numerator
        once = F.col("old_x") | (F.col("class_x") < F.col("class_y"))
        return left.join(right, ["line", "band"]).where(fits & reachable & once).select("class_x", "class_y", F.col("old_x").alias("old")).distinct()

    def _verified(self, met: DataFrame, sets: DataFrame) -> DataFrame:
        """class_1 < class_2 of those that do match on their whole sets."""
        t = self.threshold
        x, y = (sets.select(F.col("class").alias(f"class_{s}"), F.col("lines").alias(f"lines_{s}")) for s in "xy")
        shared = F.size(F.array_intersect("lines_x", "lines_y"))
        both = F.size("lines_x") + F.size("lines_y")
        good = met.join(x, "class_x").join(y, "class_y").where(shared * (t.numerator + t.denominator) >= both * t.numerator)
        return good.select(F.least("class_x", "class_y").alias("class_1"), F.greatest("class_x", "class_y").alias("class_2")).distinct()

    def probe(self, batch: DataFrame) -> tuple[DataFrame, PrefixIndex]:
        """(entry_id_1, entry_id_2 of every match of the batch with what came before it, the index with the batch appended).

        A batch may hold several deliveries; within it an earlier entry_id counts as before.
        """
        batch = materialize(files(batch, True))
        classes = materialize(self._classes(batch, self.read("counts", self._touched(batch, "counts", F.col("lines")))))
        near = self._touched(classes, "postings", self._prefix(F.col("lines")))
        met = materialize(self._met(self.read("postings", near), self.postings(classes)))
        # A class of the batch that history has met itself there, since equal sets have equal prefixes.
        known = met.where("old and class_x = class_y").select(F.col("class_x").alias("class"))
        met = met.where("class_x <> class_y")
        far = self._touched(met.where("old"), "sets", F.array("class_x"))
        fresh = classes.select("class", "lines")
        sets = self.read("sets", far).join(fresh.select("class"), "class", "left_anti").unionByName(fresh)
        pairs = materialize(self._verified(met.select("class_x", "class_y").distinct(), sets))
        self._write("links", pairs)

        here = self._touched(batch, "digests", F.array_compact(F.array("digest")))
        classes_here = classes.select("class")
        homes = self._touched(pairs.select(F.array("class_1", "class_2").alias("c")).unionByName(classes_here.select(F.array("class").alias("c"))), "members", F.col("c"))
        columns = ["key", "entry_id", "staged", "fresh"]

        def sides(old: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
            both = old.select(F.col(key).alias("key"), "entry_id", "staged", F.lit(False).alias("fresh")).unionByName(new.where(F.col(key).isNotNull()).select(F.col(key).alias("key"),
                "entry_id", "staged", F.lit(True).alias("fresh")))
            return tuple(df.select(*[F.col(c).alias(f"{c}_{x}") for c in columns]) for df, x in ((both, "e"), (both.where("fresh"), "f")))

        # Each pair once: of two new entries the later is the one that finds.
        once = (F.col("entry_id_e") != F.col("entry_id_f")) & (~F.col("fresh_e") | (F.col("entry_id_e") < F.col("entry_id_f")))
        shown = F.when(F.col("entry_id_e") < F.col("entry_id_f"), F.col("staged_f")).otherwise(F.col("staged_e"))
        pair = (F.least("entry_id_e", "entry_id_f").alias("entry_id_1"), F.greatest("entry_id_e", "entry_id_f").alias("entry_id_2"))
        e, f = sides(self.read("members", homes), batch, "class")
        ways = pairs.select(F.col("class_1").alias("key_e"), F.col("class_2").alias("key_f")).unionByName(pairs.select(F.col("class_2").alias("key_e"), F.col("class_1").alias("key_f")))
        ways = ways.unionByName(classes_here.select(F.col("class").alias("key_e"), F.col("class").alias("key_f")))
        by_lines = ways.join(f, "key_f").join(e, "key_e").where(once & shown).select(*pair)
        e, f = sides(self.read("digests", here), batch, "digest")
        by_digest = e.join(f, F.col("key_e") == F.col("key_f")).where(once & shown).select(*pair)
        self._write("found", by_lines.unionByName(by_digest).distinct())
        index = self._append(batch, classes.join(known, "class", "left_anti"))
        return self.spark.read.schema(TABLES["found"]).parquet(f"{self.path}/found/delivery={self.deliveries}"), index


def in_order(accepted: DataFrame, staged: DataFrame, deliveries: int = DELIVERIES, path: str | None = None) -> PrefixIndex:
    """The index after all batches of `staged`, in the order of batch_no; neighbouring batches share a delivery if there are more than `deliveries`."""
    index = PrefixIndex.build(accepted, path)
    numbers = [r["batch_no"] for r in staged.groupBy("batch_no").count().select("batch_no").collect()]  # one number a batch
    numbers.sort(key=lambda b: (b is not None, b or 0))
    size = max(1, math.ceil(len(numbers) / deliveries))
    for k in range(0, len(numbers), size):
        some = numbers[k : k + size]
        inside = F.col("batch_no").isin([b for b in some if b is not None])
        index = index.probe(staged.where(F.when(F.col("batch_no").isNull(), None in some).otherwise(inside)))[1]
    return index


def duplicates(accepted: DataFrame, staged: DataFrame, deliveries: int = DELIVERIES) -> DataFrame:
    """entry_id_1, entry_id_2: every staged candidate with every accepted file or earlier candidate it matches."""
    index = in_order(accepted, staged, deliveries)
    if index.deliveries == 1:
        return index.spark.createDataFrame([], TABLES["found"])
    return index.read("found")


def links(index: PrefixIndex) -> tuple[DataFrame, DataFrame]:
    """(entry_id, class, links of every file with lines; class_1, class_2 of all classes that match): the matches by lines without expansion.

    `links` counts the other classes that a file's class matches. Only pairs with a class of a delivery after the first are there.
    """
    pairs = index.read("links").distinct() if index.deliveries > 1 else index.spark.createDataFrame([], TABLES["links"])
    ends = pairs.select(F.explode(F.array("class_1", "class_2")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    members = index.read("members").select("entry_id", "class").join(ends, "class", "left")
    return members.select("entry_id", "class", F.coalesce("links", F.lit(0)).alias("links")), pairs
