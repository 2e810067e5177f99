"""History of changing attributes: insert-only satellites and lead-based validity.

Observations say "this key had these attribute values on every day from..to" and are loaded over
time; later loads overrule earlier ones day by day. The work is split so that no key, however
hot, meets in one task before it has been reduced to its calendar:

1. Each observation is clipped to calendar blocks of `WIDTH` days; equal clips of a key are
   reduced to the latest one before the shuffle (at most WIDTH*(WIDTH+1)/2 remain per block).
2. Within a block the latest observation holds on each elementary span.
3. Spans of a key, at most one a day of the calendar, are read in date order. A satellite row is
   appended only where the hash of its attribute group differs from the one before; attributes
   are split by how often they change, one satellite each.
4. End dates are not stored. `history_view` derives them with lead() from what was covered
   before the next row.

Nulls: an observation without key, attribute or first day, or with its bounds in wrong order, is
left out; a null last day means the open end; text that is no ISO date counts as null for the
first day, and leaves the row out for the last. A null load time is older than any other. Empty
input gives an empty result. Ties in the load time are broken by the greater row id. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_day
from ..functions.text import norm

OPEN_END = "2026-09-18"
WIDTH = 64


def observations(tickers: DataFrame, open_end: str = OPEN_END) -> DataFrame:
    """key, lo, hi (days since 1970), loaded_at, seq, ticker, series of every usable row."""
    lo = iso_day(F.col("date_from"))
    hi = F.when(F.col("date_to").isNull(), F.lit(open_end).cast("date")).otherwise(iso_day(F.col("date_to")))
    return tickers.select(
        norm(F.col("identity")).alias("key"),
        F.unix_date(lo).alias("lo"),
        F.unix_date(hi).alias("hi"),
        F.col("loaded_at").alias("loaded_at"),
        F.col("obs_id").alias("seq"),
        norm(F.col("ticker")).alias("ticker"),
        norm(F.col("series")).alias("series"),
    ).where("key is not null and ticker is not null and series is not null and lo <= hi")


def resolve_spans(obs: DataFrame, attrs: list[str], width: int = WIDTH) -> DataFrame:
    """key, lo, hi, attrs: disjoint spans on which the observation with the greatest (loaded_at, seq) holds."""
    clipped = obs.select("*", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))).alias("block"))
    base = (F.col("block") * width).cast("int")
    latest = clipped.select(
        "key",
        "block",
        F.greatest("lo", base).alias("lo"),
        F.least("hi", base + (width - 1)).alias("hi"),
        F.struct("loaded_at", "seq", *attrs).alias("won"),
    ).groupBy("key", "block", "lo", "hi").agg(F.max("won").alias("won"))
    blocks = latest.groupBy("key", "block").agg(F.collect_list(F.struct("lo", "hi", "won")).alias("spans"))
    edges = F.array_sort(F.array_distinct(F.concat(F.transform("spans", lambda s: s["lo"]), F.transform("spans", lambda s: s["hi"] + 1))))
    blocks = blocks.withColumn("edges", edges)
    won = F.transform(
        F.slice("edges", 1, F.size("edges") - 1),
        lambda e, i: F.struct(
            e.alias("lo"),
            (F.col("edges")[i + 1] - 1).alias("hi"),
            F.array_max(F.transform(F.filter("spans", lambda s: (s["lo"] <= e) & (e <= s["hi"])), lambda s: s["won"])).alias("won"),
        ),
    )
    held = blocks.select("key", F.explode(won).alias("s")).where("s.won is not null")
    return held.select("key", "s.lo", "s.hi", *[F.col(f"s.won.{a}").alias(a) for a in attrs])


def hash_diff(columns: list[str]) -> Column:
    """Hash of an attribute group; values are length-prefixed, so ('a','bc') and ('ab','c') differ, as do '' and null."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.coalesce(F.length(c), F.lit(-1)), F.col(c))])


def satellites(spans: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Insert-only satellite rows (key, satellite, valid_from, covered_before, hash, values).

    `groups` names the attribute groups by change rate. A row appears only where the hash of its
    group differs from the group's row before; `covered_before` is the last covered day before it.
    A closing row of the satellite '' carries the last covered day of the key.
    """
    w = Window.partitionBy("key").orderBy("lo")
    hashed = spans.select("*", *[hash_diff(cols).alias(f"h_{g}") for g, cols in groups.items()])
    seen = hashed.select(
        "*",
        F.lag("hi").over(w).alias("covered_before"),
        F.lead("lo").over(w).isNull().alias("is_last"),
        *[F.lag(f"h_{g}").over(w).alias(f"p_{g}") for g in groups],
    )
    values = lambda cols: F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c))])
    rows = [
        F.when(
            ~F.col(f"h_{g}").eqNullSafe(F.col(f"p_{g}")),
            F.struct(F.lit(g).alias("satellite"), F.col("lo").alias("valid_from"), F.col("covered_before"), F.col(f"h_{g}").alias("hash"), values(cols).alias("values")),
        )
        for g, cols in groups.items()
    ]
    end = F.when(
        F.col("is_last"),
        F.struct(
            F.lit("").alias("satellite"), (F.col("hi") + 1).alias("valid_from"), F.col("hi").alias("covered_before"), F.lit(None).cast("bigint").alias("hash"),
            F.lit(None).cast("map<string,string>").alias("values"),
        ),
    )
    out = seen.select("key", F.explode(F.filter(F.array(*rows, end), lambda r: r.isNotNull())).alias("r"))
    return out.select("key", "r.*")


def history_view(sats: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """key, attributes, date_from, date_to (days): the satellites joined on the key's timeline, ends by lead()."""
    attrs = [(g, a) for g, cols in groups.items() for a in cols]
    points = sats.groupBy("key", "valid_from").agg(
        F.max("covered_before").alias("covered_before"),
        F.max(F.col("satellite") == "").alias("closes"),
        *[F.max(F.when(F.col("satellite") == g, F.struct(F.col("values")[a].alias("v")))).alias(a) for g, a in attrs],
    )
    w = Window.partitionBy("key").orderBy("valid_from")
    view = points.select(
        "key",
        *[F.last(a, ignorenulls=True).over(w)["v"].alias(a) for _, a in attrs],
        F.col("valid_from").alias("date_from"),
        F.lead("covered_before").over(w).alias("date_to"),
        "closes",
    )
    return view.where(~F.col("closes")).drop("closes")


#: Series changes more often than the ticker.
GROUPS = {"ticker": ["ticker"], "series": ["series"]}


def ticker_history(tickers: DataFrame, open_end: str = OPEN_END) -> DataFrame:
    """identity, ticker, series, date_from, date_to (ISO): every version of every identity."""
    sats = satellites(resolve_spans(observations(tickers, open_end), ["ticker", "series"]), GROUPS)
    day = lambda c: F.date_from_unix_date(c).cast("string").alias(c)
    return history_view(sats, GROUPS).select(F.col("key").alias("identity"), "ticker", "series", day("date_from"), day("date_to"))


class SatelliteStore:
    """Satellites kept in a folder and only ever added to: a load appends the rows that its keys gain, change or lose.

    Later loads may overrule earlier days, so a row is named by (key, satellite, valid_from), the
    one of the latest load holds, and a row that is no longer true is closed by one marked `gone`.
    Keys that a load does not touch are neither read nor written.
    """

    _ROW = "key string, satellite string, valid_from int, covered_before int, hash bigint, `values` map<string,string>, gone boolean"

    def __init__(self, spark: SparkSession, path: str, groups: dict[str, list[str]] | None = None):
        self.spark, self.path, self.groups = spark, path, groups or GROUPS

    def rows(self, keys: DataFrame | None = None) -> DataFrame:
        """The satellite rows that hold now, of all keys or of those in `keys` (key)."""
        stored = self.spark.read.schema(f"{self._ROW}, load int").parquet(f"{self.path}/satellites")
        if keys is not None:
            stored = stored.join(keys, "key", "left_semi")
        latest = stored.groupBy("key", "satellite", "valid_from").agg(F.max_by(F.struct("covered_before", "hash", "values", "gone"), "load").alias("x"))
        return latest.where("not x.gone").select("key", "satellite", "valid_from", "x.covered_before", "x.hash", "x.values")

    def add(self, obs: DataFrame, touched: DataFrame, load: int) -> None:
        """Append load number `load` (from 1). `obs` are all `observations` so far, `touched` (key) the keys that the load brought; a load repeated before any later one is written over."""
        keys = touched.where("key is not null").select("key").distinct()
        attrs = [a for cols in self.groups.values() for a in cols]
        new = satellites(resolve_spans(obs.join(keys, "key", "left_semi"), attrs), self.groups)
        shape = lambda df, n: df.select(*[F.col(c).alias(f"{n}_{c}") for c in ("key", "satellite", "valid_from")], F.struct("covered_before", "hash", "values").alias(n))
        if load == 1:
            changed = new.withColumn("gone", F.lit(False))
        else:
            a, b = shape(new, "a"), shape(self.rows(keys), "b")
            same = (F.col("a_key") == F.col("b_key")) & (F.col("a_satellite") == F.col("b_satellite")) & (F.col("a_valid_from") == F.col("b_valid_from"))
            j = a.join(b, same, "full")
            other = F.col("a").isNull() | F.col("b").isNull() | ~F.col("a.hash").eqNullSafe(F.col("b.hash")) | ~F.col("a.covered_before").eqNullSafe(F.col("b.covered_before"))
            kept = F.coalesce("a", "b")
            changed = j.where(other).select(
                *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in ("key", "satellite", "valid_from")], kept["covered_before"].alias("covered_before"), kept["hash"].alias("hash"),
                    kept["values"].alias("values"),
                F.col("a").isNull().alias("gone"),
            )
        changed.write.mode("overwrite").parquet(f"{self.path}/satellites/load={load}")

    def view(self) -> DataFrame:
        """`history_view` of what is stored."""
        return history_view(self.rows(), self.groups)


def append_snapshot(current: DataFrame, snapshot: DataFrame, keys: list[str], attrs: list[str], as_of: str) -> DataFrame:
    """The satellite rows that one periodic snapshot adds: (keys, attrs, valid_from, hash).

    `current` holds earlier satellite rows. A row is returned only if the key is new or its hash
    differs from the key's latest row; a key that is absent from the snapshot adds nothing. Null
    attributes count as values; rows with a null key are left out; of repeated rows of a key in
    one snapshot the greatest in attribute order holds.
    """
    for k in keys:
        snapshot = snapshot.where(F.col(k).isNotNull())
    last = current.groupBy(*keys).agg(F.max(F.struct("valid_from", "hash")).alias("_last"))
    new = snapshot.groupBy(*keys).agg(F.max(F.struct(*attrs)).alias("_now")).select(*keys, "_now.*").withColumn("hash", hash_diff(attrs))
    joined = new.join(last, keys, "left").where(~F.col("hash").eqNullSafe(F.col("_last.hash")))
    return joined.select(*keys, *attrs, F.lit(as_of).cast("date").alias("valid_from"), "hash")


def snapshot_view(sat: DataFrame, keys: list[str]) -> DataFrame:
    """A snapshot satellite with `valid_to` (day before the next row, null while current)."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    return sat.withColumn("valid_to", F.date_sub(F.lead("valid_from").over(w), 1))
