"""Column profiles by member, published counts that disagree, and columns that turned bad.

Checks are declared as a list and compiled into one scan: each row becomes a bit mask, repeats of
a line are reduced to the latest delivery, and one aggregation counts all bits by member and
census group. These states are sums, so they merge over files, days and members: the figures of a
member, of a census group and of a feed are further sums of the same states. They are written
once and everything else reads them (their joins are told to merge: what is small on disk here
grows with the members, and compressed states look smaller than they are); `StateStore` keeps them between loads, so that a load counts
only the members it touches. Shares of a member are held against the feed's preceding member
(`jumps`) and against control limits of the feed's whole history (`control_limits`).

Rows with the same (member_id, source_line_number) count once, the one with the greatest
(loaded_at, row_id); a null line number never repeats. Null or missing published figures are
wrong. A member without rows has no shares and takes part in no comparison. Empty tables give
empty results. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_pattern, stamp_pattern
from ..functions.isin import luhn_is_valid
from ..functions.numbers import DECIMAL_TEXT
from ..functions.text import is_blank, norm, strip
from ..session import materialize


@dataclass(frozen=True)
class Check:
    """A named condition on a row of a column; its count by member is the metric."""

    column: str
    kind: str  # blank or invalid

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"

    def condition(self) -> Column:
        c = F.col(self.column)
        if self.kind == "blank":
            return is_blank(c)
        x = norm(c)
        return F.when(is_blank(c), False).otherwise(~(x.rlike(r"^IN[A-Z0-9]{9}[0-9]\z") & F.when(x.rlike(r"^IN[A-Z0-9]{9}[0-9]\z"), luhn_is_valid(x)).otherwise(False)))


BLANKS = ("symbol", "series", "isin", "price_open", "price_high", "price_low", "price_last", "price_prev_close", "totaltrades")
CHECKS = tuple(Check(c, "blank") for c in BLANKS) + (Check("isin", "invalid"),)
GROUP = ("sgmt", "src", "fininstrmtp", "series_n")


def row_masks(rows: DataFrame, checks=CHECKS) -> DataFrame:
    """One row per delivered line: member_id, census group (null outside udiff34), mask of failed checks."""
    mask = F.lit(0)
    for i, c in enumerate(checks):
        mask = mask.bitwiseOR(F.when(c.condition(), 1 << i).otherwise(0))
    modern = F.coalesce(F.col("format_family") == "udiff34", F.lit(False))
    slim = rows.select(
        "member_id",
        "source_line_number",
        F.when(F.col("source_line_number").isNull() | F.col("member_id").isNull(), F.col("row_id")).alias("alone"),
        F.struct("loaded_at", "row_id", mask.alias("mask"), modern.alias("modern"), *[F.when(modern, F.col(c)).alias(c) for c in GROUP[:3]], F.when(modern,
            norm(F.col("series"))).alias("series_n")).alias("r"),
    )
    return slim.groupBy("member_id", "source_line_number", "alone").agg(F.max("r").alias("r")).select("member_id", "r.mask", "r.modern", *[f"r.{c}" for c in GROUP])


_STATE = "member_id bigint, modern boolean, sgmt string, src string, fininstrmtp string, series_n string, n bigint, " + ", ".join(f"{c.name} bigint" for c in CHECKS)


def states(masks: DataFrame, checks=CHECKS) -> DataFrame:
    """Mergeable states: rows and failures of every check by member and census group."""
    failed = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, 1).otherwise(0)).alias(c.name) for i, c in enumerate(checks)]
    return masks.groupBy("member_id", "modern", *GROUP).agg(F.count("*").alias("n"), *failed)


def merge(state: DataFrame, by: list[str], checks=CHECKS) -> DataFrame:
    """States summed over coarser keys."""
    return state.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c.name).alias(c.name) for c in checks])


class StateStore:
    """States kept in a folder, one part a load; of a member the states of its latest load count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _parts(self) -> DataFrame:
        return self.spark.read.schema(f"{_STATE}, load int").parquet(f"{self.path}/states")

    def add(self, rows: DataFrame, load: int) -> None:
        """Count all rows of the members that load number `load` touched and append their states; a load that is repeated is written over."""
        states(row_masks(rows)).write.mode("overwrite").parquet(f"{self.path}/states/load={load}")

    def states(self) -> DataFrame:
        every = self._parts()
        last = every.groupBy("member_id").agg(F.max("load").alias("load"))  # one narrow row a member
        return every.join(last.select(F.col("member_id").alias("_m"), F.col("load").alias("_l")), F.col("member_id").eqNullSafe(F.col("_m")) & (F.col("load") == F.col("_l"))).drop("_m", "_l", "load")


def latest(rows: DataFrame) -> DataFrame:
    """Of each delivered line the row that counts, with all its columns."""
    alone = F.when(F.col("source_line_number").isNull() | F.col("member_id").isNull(), F.col("row_id"))
    rest = [c for c in rows.columns if c not in ("member_id", "source_line_number", "loaded_at", "row_id")]
    # A member is one file, so its lines may meet; by member alone the profile needs no second shuffle.
    slim = rows.repartition("member_id").select("member_id", "source_line_number", alone.alias("_alone"), F.struct("loaded_at", "row_id", *rest).alias("r"))
    return slim.groupBy("member_id", "source_line_number", "_alone").agg(F.max("r").alias("r")).select("member_id", "source_line_number", "r.*").select(*rows.columns)


def column_profile(rows: DataFrame) -> DataFrame:
    """The profile of every column, per member: a row each with

    rows, blanks; distinct_sketch, a HyperLogLog state of the values that are not blank (`hll_union_agg`
    merges it over members), and distinct_estimate of it; numbers, dates and codes, the values that are
    plain decimals, real dates (ISO, DD-Mon-YYYY or a timestamp) and valid security codes, blanks around
    them aside; the range of numbers and of dates by value, and of all other values that are not blank
    by text. Numbers beyond decimal(38,10) count as text. Lines delivered twice count once.
    """
    whole = lambda c, pattern: c.rlike(rf"^\s*(?:{pattern})\s*\z")
    stamps = {c for c, t in rows.dtypes if t in ("timestamp", "timestamp_ntz", "date")}
    cell = lambda c: F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("text"), (F.col(c) if c in stamps else F.lit(None)).cast("date").alias("given"))
    # A cell a row: one short aggregation instead of a dozen expressions a column, which take minutes to compile.
    cells = latest(rows).select("member_id", F.explode(F.array(*map(cell, rows.columns))).alias("c")).select("member_id", "c.*")
    t = F.col("text")
    # Plain tests go first, so that a cell meets only the patterns that it could match.
    is_empty = F.when(F.ascii(t) > 32, False).otherwise(is_blank(t))
    hyphens, long = F.instr(t, "-") > 1, F.length(t) >= 12
    day = F.coalesce("given", F.when(hyphens & whole(t, iso_pattern()), t.try_cast("date")).when(hyphens & whole(t, stamp_pattern()), F.try_to_date(F.initcap(strip(t)), "dd-MMM-yyyy")))
    code = F.when(long & whole(t, "(?i:IN[A-Z0-9]{9}[0-9])"), luhn_is_valid(norm(t)))
    number = F.when(F.col("given").isNull() & whole(t, DECIMAL_TEXT), t.try_cast("decimal(38,10)"))
    cells = cells.select("member_id", "field_name", "text", is_empty.alias("blank"), number.alias("number"), day.alias("date"), code.alias("code"))
    other = F.when(~F.col("blank") & F.col("number").isNull() & F.col("date").isNull(), t)
    ends = [f(v).alias(f"{end}_{what}") for what, v in (("number", F.col("number")), ("date", F.col("date")), ("text", other)) for end, f in (("least", F.min), ("greatest", F.max))]
    out = cells.groupBy("member_id", "field_name").agg(
        F.count("*").alias("rows"), F.count_if("blank").alias("blanks"), F.hll_sketch_agg(F.when(~F.col("blank"), t), F.lit(12)).alias("distinct_sketch"),
        F.count("number").alias("numbers"), F.count("date").alias("dates"), F.count_if("code").alias("codes"), *ends,
    )
    return out.withColumn("distinct_estimate", F.hll_sketch_estimate("distinct_sketch"))


def wrong_counts(state: DataFrame, file_metrics: DataFrame, census: DataFrame, members: DataFrame) -> DataFrame:
    """table_name, row_key, field_name of published figures that are null or not the count."""
    per_member = merge(state, ["member_id"]).select("member_id", F.col("blank_isin").alias("_b"), F.col("invalid_isin").alias("_i"))
    fm = file_metrics.select("metric_id", "member_id", "blank_isin_rows", "invalid_isin_rows").join(per_member.hint("merge"), "member_id", "left")
    off = lambda said, counted: ~F.coalesce(F.col(said) == F.coalesce(F.col(counted), F.lit(0)), F.lit(False))
    pick = lambda f, bad: F.when(bad, F.lit(f))
    a = fm.select(
        F.lit("file_metrics").alias("table_name"), F.col("metric_id").alias("row_key"),
        F.explode(F.array_compact(F.array(pick("blank_isin_rows", off("blank_isin_rows", "_b")), pick("invalid_isin_rows", off("invalid_isin_rows", "_i"))))).alias("field_name"),
    )

    dated = members.select("member_id", F.col("feed").alias("_feed"), F.col("date_from_filename").alias("_day"))
    groups = state.where("modern").hint("merge").join(dated, "member_id").groupBy("_feed", "_day", *GROUP).agg(F.sum("blank_isin").alias("_b"))
    ask = census.select("group_id", "feed", "period_from", "period_to", F.col("sgmt").alias("_g0"), F.col("src").alias("_g1"), F.col("fininstrmtp").alias("_g2"),
        norm(F.col("sctysrs")).alias("_g3"), "blank_or_ws_isin_rows")
    same = (F.col("feed") == F.col("_feed")) & F.col("_day").between(F.col("period_from"), F.col("period_to"))
    for i, c in enumerate(GROUP):
        same = same & F.col(f"_g{i}").eqNullSafe(F.col(c))
    counted = ask.join(groups.hint("merge"), same, "left").groupBy("group_id").agg(F.first("blank_or_ws_isin_rows").alias("said"), F.sum("_b").alias("_b"))
    b = counted.where(off("said", "_b")).select(F.lit("ud_census_groups").alias("table_name"), F.col("group_id").alias("row_key"), F.lit("blank_or_ws_isin_rows").alias("field_name"))
    return a.unionByName(b).withColumn("finding", F.lit("wrong_count"))


def jumps(state: DataFrame, members: DataFrame, percent: int = 15, checks=CHECKS) -> DataFrame:
    """member_id rows whose share of failures of a check rose by more than `percent` points against the feed's preceding member."""
    w = Window.partitionBy("feed").orderBy("date_from_filename", "member_id")
    per = members.select("member_id", "feed", "date_from_filename").join(merge(state, ["member_id"]).hint("merge"), "member_id", "left")
    per = per.select("*", F.lag("n").over(w).alias("n0"), *[F.lag(c.name).over(w).alias(f"{c.name}_0") for c in checks])
    rose = lambda c: (F.col(c.name) * F.col("n0") - F.col(f"{c.name}_0") * F.col("n")) * 100 > percent * F.col("n") * F.col("n0")
    kind = lambda c: F.lit("blank_jump" if c.kind == "blank" else "pattern_jump")
    found = F.array_compact(F.array(*[F.when(rose(c), F.struct(F.lit(c.column).alias("field_name"), kind(c).alias("finding"))) for c in checks]))
    return per.where("n > 0 and n0 > 0").select(F.lit("members").alias("table_name"), F.col("member_id").alias("row_key"), F.explode(found).alias("x")).select("table_name", "row_key", "x.*")


def findings(rows: DataFrame, members: DataFrame, file_metrics: DataFrame, census: DataFrame) -> DataFrame:
    """table_name, row_key, field_name, finding: wrong published counts and columns that turned bad."""
    return findings_of(materialize(states(row_masks(rows))), members, file_metrics, census)


def findings_of(state: DataFrame, members: DataFrame, file_metrics: DataFrame, census: DataFrame) -> DataFrame:
    """`findings` from written states."""
    return wrong_counts(state, file_metrics, census, members).unionByName(jumps(state, members))


def control_limits(state: DataFrame, members: DataFrame, sigmas: float = 3.0, least: int = 8) -> DataFrame:
    """feed, member_id, metric, share, mean, limit: shares beyond mean + `sigmas` standard deviations (0.001 at least) of all earlier members of the feed.

    Days are summed up month by month, so no feed's whole history is sorted in one task: a member
    meets the earlier days of its month, and one row for each earlier month. Fewer than `least`
    earlier members give no limit. Members without rows do not count.
    """
    per = members.where("date_from_filename is not null").select("member_id", "feed", "date_from_filename").join(merge(state, ["member_id"]), "member_id").where("n > 0")
    share = F.explode(F.array(*[F.struct(F.lit(c.name).alias("metric"), (F.col(c.name) / F.col("n")).alias("share")) for c in CHECKS]))
    month = (F.year("date_from_filename") * 12 + F.month("date_from_filename")).alias("month")
    long = per.select("feed", "date_from_filename", month, "member_id", share.alias("x")).select("feed", "month", "date_from_filename", "member_id", "x.*")
    # Count, sum and sum of squares merge; the mean and the deviation come from them.
    sums = {"seen": F.count("share"), "total": F.sum("share"), "square": F.sum(F.col("share") * F.col("share"))}
    months = long.groupBy("feed", "metric", "month").agg(*[f.alias(k) for k, f in sums.items()])
    earlier = Window.partitionBy("feed", "metric").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select(F.col("feed").alias("_f"), F.col("metric").alias("_k"), F.col("month").alias("_t"), *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"m_{k}") for k in sums])
    before = Window.partitionBy("feed", "metric", "month").orderBy("date_from_filename", "member_id").rowsBetween(Window.unboundedPreceding, -1)
    long = long.select("*", *[f.over(before).alias(f"d_{k}") for k, f in sums.items()])
    both = long.join(months, F.col("feed").eqNullSafe(F.col("_f")) & (F.col("metric") == F.col("_k")) & (F.col("month") == F.col("_t")))
    seen, total, square = (F.coalesce(f"d_{k}", F.lit(0)) + F.col(f"m_{k}") for k in sums)
    both = both.select("feed", "member_id", "metric", "share", seen.alias("seen"), total.alias("total"), square.alias("square")).where(F.col("seen") >= least)
    mean = F.col("total") / F.col("seen")
    deviation = F.sqrt(F.greatest(F.col("square") / F.col("seen") - mean * mean, F.lit(0.0)))
    both = both.select("feed", "member_id", "metric", "share", mean.alias("mean"), (mean + sigmas * F.greatest(deviation, F.lit(0.001))).alias("limit"))
    return both.where("share > limit")
