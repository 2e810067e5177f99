"""Queries of the evidence toolkit: classes of series, verdicts, dispositions, ordered documents, projections and identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..functions.numbers import strict_decimal
from ..functions.text import is_blank, norm
from ..operators import islands as isl
from ..schema import OVERLAY_SERIES
from ..session import table
from .views import ROWS, once, rows

QUERIES, SQL = {}, {}


def query(sql: str | None = None, with_rows: bool = True):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"with {ROWS}{sql}" if with_rows else sql
        return f

    return add


_OV = "('" + "', '".join(OVERLAY_SERIES) + "')"

# ---- classes of series

# Pattern of a whole series token and its class; the first that matches holds.
SERIES_CLASSES = (
    ("EQ", "EQUITY_COMMON"),
    ("SM", "EQUITY_SME"),
    ("BE", "EQUITY_T2T_RIGHTS_AMBIGUOUS"),
    ("BZ", "EQUITY_T2T"),
    ("ST|SZ", "EQUITY_SME_T2T"),
    ("E[1-9A-Z]", "EQUITY_PARTLYPAID"),
    ("X[1-9A-Z]", "EQUITY_PARTLYPAID_T2T"),
    ("BL", "OVERLAY_BLOCK_DEALS"),
    ("BO", "OVERLAY_BUYBACK_WINDOW"),
    ("T0", "OVERLAY_T0_SETTLEMENT"),
    ("IT|IL", "OVERLAY_INSTITUTIONAL_WINDOW_HYPOTHESIS"),
    ("P[1-9A-Z]", "EQUITY_LINKED_PREFERRED_NC"),
    ("Q[1-9A-Z]", "EQUITY_LINKED_PREFERRED_FC"),
    ("W[1-9A-Z]", "EQUITY_LINKED_WARRANT"),
    ("K[1-9A-Z]", "EQUITY_LINKED_WARRANT_T2T"),
    ("MF", "NON_EQUITY_MUTUAL_FUND"),
    ("ME", "NON_EQUITY_MUTUAL_FUND_T2T"),
    ("IV|ID", "NON_EQUITY_INVIT"),
    ("RR|RT", "NON_EQUITY_REIT"),
    ("GB", "NON_EQUITY_GOLD_BOND"),
    ("GS", "NON_EQUITY_GOVT_SEC"),
    ("TB", "NON_EQUITY_TREASURY_BILL"),
    ("SG", "NON_EQUITY_SDL"),
    ("[NYZAB][0-9A-Z]", "NON_EQUITY_CORP_BOND_NC"),
    ("[UM][0-9A-Z]", "NON_EQUITY_CORP_BOND_NC_T2T"),
    ("D[0-9A-Z]", "NON_EQUITY_CORP_BOND_FC"),
    ("SF", "NON_EQUITY_CORP_BOND_FC_T2T"),
)
UNCLASSIFIED = "UNCLASSIFIED"


def series_class(series: Column) -> Column:
    """Class of a series token as published; null and unknown tokens are unclassified."""
    rest = F.lit(UNCLASSIFIED)
    for pattern, name in reversed(SERIES_CLASSES):
        rest = F.when(series.rlike(rf"^(?:{pattern})\z"), name).otherwise(rest)
    return rest


_CLASS = r"""case when series in ('EQ') then 'EQUITY_COMMON' when series = 'SM' then 'EQUITY_SME' when series = 'BE' then 'EQUITY_T2T_RIGHTS_AMBIGUOUS' when series = 'BZ' then 'EQUITY_T2T'
  when series in ('ST', 'SZ') then 'EQUITY_SME_T2T' when series in ('BL') then 'OVERLAY_BLOCK_DEALS' when series = 'BO' then 'OVERLAY_BUYBACK_WINDOW' when series = 'T0' then 'OVERLAY_T0_SETTLEMENT'
  when series in ('IT', 'IL') then 'OVERLAY_INSTITUTIONAL_WINDOW_HYPOTHESIS' when series = 'MF' then 'NON_EQUITY_MUTUAL_FUND' when series = 'ME' then 'NON_EQUITY_MUTUAL_FUND_T2T'
  when series in ('IV', 'ID') then 'NON_EQUITY_INVIT' when series in ('RR', 'RT') then 'NON_EQUITY_REIT' when series = 'GB' then 'NON_EQUITY_GOLD_BOND' when series = 'GS' then 'NON_EQUITY_GOVT_SEC'
  when series = 'TB' then 'NON_EQUITY_TREASURY_BILL' when series = 'SG' then 'NON_EQUITY_SDL' when series = 'SF' then 'NON_EQUITY_CORP_BOND_FC_T2T'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[1-9A-Z]') and series[1] = 'E' then 'EQUITY_PARTLYPAID'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[1-9A-Z]') and series[1] = 'X' then 'EQUITY_PARTLYPAID_T2T'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[1-9A-Z]') and series[1] = 'P' then 'EQUITY_LINKED_PREFERRED_NC'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[1-9A-Z]') and series[1] = 'Q' then 'EQUITY_LINKED_PREFERRED_FC'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[1-9A-Z]') and series[1] = 'W' then 'EQUITY_LINKED_WARRANT'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[1-9A-Z]') and series[1] = 'K' then 'EQUITY_LINKED_WARRANT_T2T'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[0-9A-Z]') and series[1] in ('N', 'Y', 'Z', 'A', 'B') then 'NON_EQUITY_CORP_BOND_NC'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[0-9A-Z]') and series[1] in ('U', 'M') then 'NON_EQUITY_CORP_BOND_NC_T2T'
  when length(series) = 2 and regexp_full_match(substr(series, 2), '[0-9A-Z]') and series[1] = 'D' then 'NON_EQUITY_CORP_BOND_FC' else 'UNCLASSIFIED' end"""


@query(f" select series, {_CLASS} as class, count(*) as row_count, count(distinct trade_date) as days from rows where series is not null group by series")
def series_classes(spark, sf):
    g = rows(spark, sf).where("series is not null").groupBy("series").agg(F.count("*").alias("row_count"), F.countDistinct("trade_date").alias("days"))
    return g.select("series", series_class(F.col("series")).alias("class"), "row_count", "days")


@query(f""", g as (select {_CLASS} as class, count(*) as row_count, count(distinct series) as series_count from rows group by 1)
select class, row_count, series_count, round(100.0 * row_count / sum(row_count) over (), 3) as percent from g""")
def class_rollup(spark, sf):
    """Rows and distinct series of every class, and their percentage of all rows."""
    per = rows(spark, sf).groupBy("series").agg(F.count("*").alias("n"))
    g = per.groupBy(series_class(F.col("series")).alias("class")).agg(F.sum("n").alias("row_count"), F.count("series").alias("series_count"))
    share = F.round(F.lit(100.0) * F.col("row_count") / F.sum("row_count").over(Window.partitionBy(F.lit(1))), 3)  # a row a class
    return g.select("class", "row_count", "series_count", share.alias("percent"))


# ---- metrics and coverage


@query(r""", g as (select member_id, upper(trim(coalesce(symbol, ''))) as sy, upper(trim(coalesce(series, ''))) as se, isin_n from rows)
select member_id, count(*) as row_count, count(distinct (sy, se)) as pairs, count(*) - count(distinct (sy, se)) as pair_duplicates,
  count(*) filter (isin_n <> '') - count(distinct case when isin_n <> '' then isin_n end) as extra_isin_rows from g group by member_id""")
def file_metrics_upper(spark, sf):
    """Metrics of a file with symbol and series both in upper case."""
    up = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    code = F.when(F.col("isin_n") != "", F.col("isin_n"))
    g = rows(spark, sf).groupBy("member_id").agg(F.count("*").alias("row_count"), F.countDistinct(F.struct(up("symbol"), up("series"))).alias("pairs"),
        (F.count(code) - F.countDistinct(code)).alias("extra_isin_rows"))
    return g.withColumn("pair_duplicates", F.col("row_count") - F.col("pairs"))


# Parts of a symbol that hint at a fund.
FUND_HINTS = ("ETF", "BEES")


@query(r""", k as (
  select member_id, 'SERIES:' || upper(trim(series)) as key from rows where trim(series) <> ''
  union all select member_id, 'SYMBOL_RE_prefix' from rows where starts_with(upper(trim(symbol)), 'RE')
  union all select member_id, 'SYMBOL_ETF_hint' from rows where contains(upper(symbol), 'ETF') or contains(upper(symbol), 'BEES')
  union all select member_id, 'TRADDT_NE_BIZDT' from rows where format_family = 'udiff34' and trim(raw_biz_dt) <> strftime(trade_date, '%Y-%m-%d'))
select member_id, key, count(*) as n from k group by all""")
def coverage_histogram(spark, sf):
    """How often each series, prefix, hint and date mismatch occurs in a file."""
    sym, ser = F.upper(F.trim("symbol")), F.upper(F.trim("series"))
    hint = reduce(lambda a, b: a | b, [F.upper("symbol").contains(h) for h in FUND_HINTS])
    other = (F.col("format_family") == "udiff34") & (F.trim("raw_biz_dt") != F.col("trade_date").cast("string"))
    keys = F.array_compact(F.array(F.when(ser != "", F.concat(F.lit("SERIES:"), ser)), F.when(sym.startswith("RE"), F.lit("SYMBOL_RE_prefix")), F.when(hint, F.lit("SYMBOL_ETF_hint")),
        F.when(other, F.lit("TRADDT_NE_BIZDT"))))
    return rows(spark, sf).select("member_id", F.explode(keys).alias("key")).groupBy("member_id", "key").agg(F.count("*").alias("n"))


@query("""select r.member_id, count(distinct r.line_number) as extract_rows, m.row_count as full_rows, case when m.row_count > 0 then round(count(distinct r.line_number) / m.row_count, 6) end as ratio
from raw_records r join members m using (member_id) group by r.member_id, m.row_count""", False)
def extract_coverage(spark, sf):
    """How much of each file its extract of lines covers; null where the size of the file is unknown or 0."""
    x = table(spark, sf, "raw_records").groupBy("member_id").agg(F.countDistinct("line_number").alias("extract_rows"))
    j = x.join(table(spark, sf, "members").select("member_id", F.col("row_count").alias("full_rows")), "member_id")
    return j.withColumn("ratio", F.when(F.col("full_rows") > 0, F.round(F.col("extract_rows") / F.col("full_rows"), 6)))


@query(f"""select min(ratio) as least, max(ratio) as most, count(*) as files, count(ratio) as known from ({SQL["extract_coverage"]}) z""", False)
def extract_coverage_range(spark, sf):
    return extract_coverage(spark, sf).agg(F.min("ratio").alias("least"), F.max("ratio").alias("most"), F.count("*").alias("files"), F.count("ratio").alias("known"))


# ---- dispositions of published groups

_KEYS = ("sgmt", "src", "fininstrmtp", "series_n")
_DISPOSITION = r""", pe as (select distinct feed, period_from, period_to from ud_census_groups where feed is not null and period_from is not null and period_to is not null),
ob as (select pe.feed, pe.period_from, pe.period_to, sgmt, src, fininstrmtp, upper(regexp_replace(series, '^\s+|\s+$', '', 'g')) as series_n, count(distinct (member_id, source_line_number)) as counted
  from rows join pe on pe.feed = rows.feed and trade_date between pe.period_from and pe.period_to where format_family = 'udiff34' group by all),
pb as (select group_id, feed, period_from, period_to, sgmt, src, fininstrmtp, upper(regexp_replace(sctysrs, '^\s+|\s+$', '', 'g')) as series_n, row_count as said from ud_census_groups),
dj as (select coalesce(pb.feed, ob.feed) as feed, coalesce(pb.period_from, ob.period_from) as period_from, coalesce(pb.sgmt, ob.sgmt) as sgmt, coalesce(pb.src, ob.src) as src,
    coalesce(pb.fininstrmtp, ob.fininstrmtp) as fininstrmtp, coalesce(pb.series_n, ob.series_n) as series_n, group_id, said, counted,
    case when group_id is null then 'observed-only' when counted is null then 'published-only' when said is null then 'not-comparable'
  when said = counted then 'agrees' else 'differs' end as disposition
  from pb full join ob on pb.feed = ob.feed and pb.period_from = ob.period_from and pb.period_to = ob.period_to and pb.sgmt is not distinct from ob.sgmt and pb.src is not distinct from ob.src
    and pb.fininstrmtp is not distinct from ob.fininstrmtp and pb.series_n is not distinct from ob.series_n)"""


def _disposition(spark, sf):
    census = table(spark, sf, "ud_census_groups")
    r = rows(spark, sf).where("format_family = 'udiff34'").select("feed", "trade_date", "member_id", "source_line_number", "sgmt", "src", "fininstrmtp", norm(F.col("series")).alias("series_n"))
    periods = census.where("feed is not null and period_from is not null and period_to is not null").select("feed", "period_from", "period_to").distinct()
    # Lines by day first, so that periods meet a row a day and group.
    days = r.distinct().groupBy("feed", "trade_date", *_KEYS).agg(F.count("*").alias("n"))
    seen = days.join(periods, "feed").where("trade_date between period_from and period_to").groupBy("feed", "period_from", "period_to", *_KEYS).agg(F.sum("n").alias("counted"))
    said = census.select("group_id", "feed", "period_from", "period_to", "sgmt", "src", "fininstrmtp", norm(F.col("sctysrs")).alias("series_n"), F.col("row_count").alias("said"))
    p, o = said.alias("p"), seen.alias("o")
    on = reduce(lambda a, b: a & b, [F.col(f"p.{c}") == F.col(f"o.{c}") for c in ("feed", "period_from", "period_to")] + [F.col(f"p.{c}").eqNullSafe(F.col(f"o.{c}")) for c in _KEYS])
    state = (
        F.when(F.col("group_id").isNull(), "observed-only").when(F.col("counted").isNull(), "published-only").when(F.col("said").isNull(), "not-comparable")
        .when(F.col("said") == F.col("counted"), "agrees").otherwise("differs")
    )
    return p.join(o, on, "full").select(*[F.coalesce(f"p.{c}", f"o.{c}").alias(c) for c in ("feed", "period_from", *_KEYS)], "group_id", "said", "counted", state.alias("disposition"))


@query(_DISPOSITION + " select * from dj")
def group_disposition(spark, sf):
    """Published groups against the groups that the rows make, each in one of five states."""
    return _disposition(spark, sf)


@query(_DISPOSITION + """ select case when grouping(feed) = 0 then feed end as feed, case when grouping(fininstrmtp) = 0 then fininstrmtp end as fininstrmtp, case when
  grouping(series_n) = 0 then series_n end as series_n,
  disposition, cast(grouping(feed, fininstrmtp, series_n) as int) as level, count(*) as groups from dj group by grouping sets ((feed, disposition), (fininstrmtp, disposition), (series_n,
  disposition), (disposition))""")
def disposition_accounts(spark, sf):
    """The dispositions counted by feed, by type, by series and in all."""
    keys = ["feed", "fininstrmtp", "series_n"]
    d = _disposition(spark, sf)
    return d.groupingSets([[k, "disposition"] for k in keys] + [["disposition"]], *keys, "disposition").agg(F.grouping_id().alias("_id"), F.count("*").alias("groups")).select(
        *keys, "disposition", F.shiftright("_id", 1).cast("int").alias("level"), "groups"
    )


# ---- verdicts and comparisons

_CHAIN = """, lg as (select isin_n, arg_min_null(price_close, (trade_date, source_line_number, row_id)) as px from rows where format_family = 'legacy13' and isin_n <> '' group by isin_n),
ud as (select isin_n, arg_min_null(price_prev_close, (trade_date, source_line_number, row_id)) as px from rows where format_family = 'udiff34' and isin_n <> '' group by isin_n)"""


def _chain(spark, sf):
    r = rows(spark, sf).where("isin_n <> ''")
    order = F.struct("trade_date", "source_line_number", "row_id")
    a = r.where("format_family = 'legacy13'").groupBy("isin_n").agg(F.min_by("price_close", order).alias("close"))
    b = r.where("format_family = 'udiff34'").groupBy(F.col("isin_n").alias("_i")).agg(F.min_by("price_prev_close", order).alias("prev_close"))
    return a.join(b, F.col("isin_n") == F.col("_i"), "full")


@query(_CHAIN + """, c as (select count(*) filter (ud.isin_n is not null and lg.isin_n is not null) as matched, count(*) filter (ud.isin_n is null) as only_legacy,
  count(*) filter (lg.isin_n is null) as only_modern
  from lg full join ud on lg.isin_n = ud.isin_n),
q as (select *, matched / greatest(matched + only_legacy + only_modern, 1) as ratio from c)
select matched, only_legacy, only_modern, round(ratio, 6) as match_ratio, case when ratio > 0.99 then 'strong continuity support'
  when ratio > 0.95 then 'partial continuity' else 'significant unexplained discontinuity' end as verdict from q""")
def continuity_verdict(spark, sf):
    """How many codes both formats have, and the verdict on the change of format."""
    seen = rows(spark, sf).where("isin_n <> ''").groupBy("isin_n").agg(F.max((F.col("format_family") == "legacy13").cast("int")).alias("l"),
        F.max((F.col("format_family") == "udiff34").cast("int")).alias("u"))
    c = seen.where("l + u > 0").agg(F.count_if((F.col("l") == 1) & (F.col("u") == 1)).alias("matched"), F.count_if(F.col("u") == 0).alias("only_legacy"),
        F.count_if(F.col("l") == 0).alias("only_modern"))
    ratio = F.col("matched") / F.greatest(F.col("matched") + F.col("only_legacy") + F.col("only_modern"), F.lit(1))
    verdict = F.when(ratio > 0.99, "strong continuity support").when(ratio > 0.95, "partial continuity").otherwise("significant unexplained discontinuity")
    return c.select("*", F.round(ratio, 6).alias("match_ratio"), verdict.alias("verdict"))


@query(_CHAIN + " select isin_n, lg.px as close, ud.px as prev_close from lg join ud using (isin_n) where lg.px is distinct from ud.px order by isin_n limit 300")
def price_chain_mismatches(spark, sf):
    """The first 300 codes, in their order, whose first modern previous close is not their first legacy close: a report of that length."""
    c = _chain(spark, sf).where("isin_n is not null and _i is not null").where(~F.col("close").eqNullSafe(F.col("prev_close")))
    return c.select("isin_n", "close", "prev_close").orderBy("isin_n").limit(300)


@query(""", f as (select *, round(try_cast(price_close as double), 2) as a, round(try_cast(price_prev_close as double), 2) as b from rows)
select format_family, case when a is null or b is null then 'na' when a < b then 'lt' when a = b then 'eq' else 'gt' end as relation, count(*) as row_count from f group by all""")
def price_relation(spark, sf):
    """Close against previous close as floats of two decimals."""
    a, b = (F.round(F.col(c).try_cast("double"), 2) for c in ("price_close", "price_prev_close"))
    relation = F.when(a.isNull() | b.isNull(), "na").when(a < b, "lt").when(a == b, "eq").otherwise("gt")
    return rows(spark, sf).groupBy("format_family", relation.alias("relation")).agg(F.count("*").alias("row_count"))


@query(r""", v as (select upper(replace(trim(coalesce(isin, '')), ' ', '')) as c from rows),
k as (select case when c = '' then 'BLANK' when length(c) <> 12 then 'INVALID_LEN' when c not like 'IN%' then 'INVALID_PREFIX' when not regexp_full_match(c,
  'IN[A-Z0-9]{9}[0-9]') then 'INVALID_CHARSET' else 'SHAPED' end as category from v)
select category, count(*) as row_count from k group by category""")
def legacy_isin_shapes(spark, sf):
    """The older reading of a code, which drops inner blanks too, up to its check digit."""
    c = F.upper(F.replace(F.trim(F.coalesce("isin", F.lit(""))), F.lit(" "), F.lit("")))
    kind = (
        F.when(c == "", "BLANK").when(F.length(c) != 12, "INVALID_LEN").when(~c.startswith("IN"), "INVALID_PREFIX")
        .when(~c.rlike(r"^IN[A-Z0-9]{9}[0-9]\z"), "INVALID_CHARSET").otherwise("SHAPED")
    )
    return rows(spark, sf).groupBy(kind.alias("category")).agg(F.count("*").alias("row_count"))


@query(""", c as (select ticker, series, identity, count(*) as n from rows where ticker is not null group by all),
p as (select ticker, series from c group by ticker, series order by sum(n) desc, ticker, series limit 1), i as (select distinct identity from c join p using (ticker, series)
  where identity is not null)
select ticker as selector, rows.identity in (select identity from i) as correlated, case when rows.identity in (select identity from i) then rows.identity end as correlation_identity,
  case when rows.identity in (select identity from i) then 'valid-isin-correlation' else 'exact-observation' end as basis, count(*) as row_count
from rows join p using (ticker, series) group by all""")
def resolution_basis(spark, sf):
    """On what the rows of the busiest ticker were found: its identity, or the ticker as observed."""
    r = rows(spark, sf).where("ticker is not null")
    census = r.groupBy("ticker", "series", "identity").agg(F.count("*").alias("n"))
    pick = census.groupBy("ticker", "series").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ticker", "series").limit(1).select("ticker", "series")
    mine = census.join(F.broadcast(pick), ["ticker", "series"])  # one row
    known = F.col("identity").isNotNull()
    basis = F.when(known, "valid-isin-correlation").otherwise("exact-observation")
    correlated = F.when(known, True)
    return mine.select(F.col("ticker").alias("selector"), correlated.alias("correlated"), F.col("identity").alias("correlation_identity"), basis.alias("basis"), F.col("n").alias("row_count"))


@query(""" select year, count(*) filter (validity = 'LEN') as len, count(*) filter (validity = 'CHECKDIGIT') as checkdigit, count(*) filter (validity in ('LEN', 'CHECKDIGIT')) as total from rows group by year""")
def flag_total(spark, sf):
    """The sum over a year's map of flags, and two of its entries."""
    g = once(rows(spark, sf), "validity").where("validity in ('LEN', 'CHECKDIGIT')").groupBy("year", "validity").agg(F.count("*").alias("n"))
    maps = g.groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("validity", "n"))).alias("census"))  # two entries a year
    years = rows(spark, sf).select("year").distinct().join(maps, "year", "left")
    of = lambda k: F.coalesce(F.col("census")[k], F.lit(0))
    total = F.coalesce(F.aggregate(F.map_values("census"), F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    return years.select("year", of("LEN").alias("len"), of("CHECKDIGIT").alias("checkdigit"), total.alias("total"))


@query("select distinct date_from_filename as day, cast(date_from_filename - date '1970-01-01' as int) as number, date '1970-01-01' + cast(date_from_filename - date '1970-01-01' as int) = date_from_filename as back from members where date_from_filename is not null", False)
def day_numbers(spark, sf):
    d = F.col("day")
    days = table(spark, sf, "members").select(F.col("date_from_filename").alias("day")).where("day is not null").distinct()
    return days.select("day", F.datediff(d, F.lit("1970-01-01").cast("date")).alias("number"), (F.date_from_unix_date(F.unix_date(d)) == d).alias("back"))


# ---- ordered documents

_ASSOC = f""", k as (select * from rows where isin_n <> '' and coalesce(series not in {_OV}, true)),
s as (select *, case when row_number() over w > 1 and symbol is not distinct from lag(symbol) over w and series is not distinct from lag(series) over w then 0 else 1 end as st
  from k window w as (partition by isin_n order by trade_date, source_line_number, row_id)),
i as (select *, sum(st) over (partition by isin_n order by trade_date, source_line_number, row_id) as island from s),
a as (select isin_n, island, coalesce(symbol, '') as symbol, coalesce(series, '') as series, min(trade_date) as date_from, max(trade_date) as date_to from i group by all)"""


@query(_ASSOC + """ select isin_n, cast(year(date_from) as int) as year, count(*) as associations,
  string_agg(strftime(date_from, '%Y-%m-%d') || '..' || strftime(date_to, '%Y-%m-%d') || ' ' || symbol || '/' || series, '; ' order by date_from, symbol, series, date_to) as document
from a group by isin_n, year(date_from)""")
def association_documents(spark, sf):
    """The associations of a code that begin in a year as one document, in the order of first day, symbol and series."""
    keyed = rows(spark, sf).where((F.col("isin_n") != "") & F.coalesce(~F.col("series").isin(*OVERLAY_SERIES), F.lit(True)))
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    a = isl.associations(keyed).select("isin_n", F.year("date_from").alias("year"), "date_from", text("symbol"), text("series"), "date_to")
    parts = F.array_sort(F.collect_list(F.struct("date_from", "symbol", "series", "date_to")))  # those of one code and year
    line = lambda p: F.concat(p["date_from"].cast("string"), F.lit(".."), p["date_to"].cast("string"), F.lit(" "), p["symbol"], F.lit("/"), p["series"])
    g = a.groupBy("isin_n", "year").agg(F.count("*").alias("associations"), parts.alias("p"))
    return g.select("isin_n", "year", "associations", F.array_join(F.transform("p", line), "; ").alias("document"))


_LINKED = f""", bs as (select member_id, isin_n as k, source_line_number as base_line, row_number() over (partition by member_id, isin_n order by source_line_number, row_id) as n
  from rows where coalesce(series not in {_OV}, true) and isin_n <> '')"""


@query(_LINKED + f""" select o.row_id, o.member_id, coalesce(b.base_line, 0) as base_line, cast(row_number() over (partition by o.member_id order by o.trade_date, o.series, o.isin_n,
  coalesce(b.base_line, 0), o.row_id) as int) as position
from rows o left join bs b on b.member_id = o.member_id and b.k = o.isin_n and b.n = 1 where o.series in {_OV}""")
def overlay_order(spark, sf):
    """Overlay rows of each file in the order of day, series, code and base line (0 without one)."""
    linked = isl.link_overlays(rows(spark, sf), OVERLAY_SERIES).select("row_id", "member_id", "trade_date", "series", "isin_n", F.coalesce("base_line", F.lit(0)).alias("base_line"))
    w = Window.partitionBy("member_id").orderBy("trade_date", "series", "isin_n", "base_line", "row_id")
    return linked.select("row_id", "member_id", "base_line", F.row_number().over(w).alias("position"))


@query("""select relative_path, detected_format, size_bytes, date_from_filename, cast(rank as int) as rank from (
  select *, row_number() over (order by detected_format, size_bytes desc nulls last, date_from_filename desc nulls last, relative_path) as rank from members) z where rank <= 50""", False)
def inventory_sorted(spark, sf):
    """The first fifty archives by format upwards, size and day downwards: a page of a sorted view."""
    order = [F.asc_nulls_last("detected_format"), F.desc_nulls_last("size_bytes"), F.desc_nulls_last("date_from_filename"), F.asc("relative_path")]
    top = table(spark, sf, "members").select("relative_path", "detected_format", "size_bytes", "date_from_filename").orderBy(*order).limit(50)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # fifty rows


@query(""" select file_name, row_id, cast(row_number() over (partition by file_name order by trade_date, format_family, coalesce(source_line_number, 0), row_id) as int) as position from rows""")
def served_order(spark, sf):
    """The place of every row of a file in the order in which rows are served."""
    w = Window.partitionBy("file_name").orderBy("trade_date", "format_family", F.coalesce("source_line_number", F.lit(0)), "row_id")
    return rows(spark, sf).select("file_name", "row_id", F.row_number().over(w).alias("position"))


# ---- projections and identities


@query(""" select file_name, source_line_number, trade_date, identity, ticker, series, symbol as raw_symbol, row_id,
  sha256(concat_ws('|', file_name, source_line_number, strftime(trade_date, '%Y-%m-%d'), coalesce(identity, ''), coalesce(ticker, ''), coalesce(series, ''), coalesce(symbol, ''))) as projection_sha256
from rows where trade_date is not null and source_line_number is not null""")
def continuity_projection(spark, sf):
    """What continuity needs of a row, with a digest of it; rows without day or line number are left out."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat_ws("|", "file_name", F.col("source_line_number").cast("string"), F.col("trade_date").cast("string"), *[text(c) for c in ("identity", "ticker", "series", "symbol")])
    r = once(rows(spark, sf).where("trade_date is not null and source_line_number is not null"), "identity")
    return r.select("file_name", "source_line_number", "trade_date", "identity", "ticker", "series", F.col("symbol").alias("raw_symbol"), "row_id", F.sha2(line, 256).alias("projection_sha256"))


@query("select root, relative_path, file_name, size_bytes, date_from_filename, sha256, detected_format, row_count, header_width from members", False)
def inventory_facts(spark, sf):
    """The nine facts of the inventory on every archive."""
    return table(spark, sf, "members").select("root", "relative_path", "file_name", "size_bytes", "date_from_filename", "sha256", "detected_format", "row_count", "header_width")


@query("select entry_id, k.key as key, k.value as value from (select entry_id, unnest(map_entries(cast(cast(record as json) as map(varchar, varchar)))) as k from accepted where json_valid(record)) z", False)
def record_sections(spark, sf):
    """The entries that each record has, as published; what a record lacks has no row."""
    entries = F.from_json("record", "map<string,string>")
    return table(spark, sf, "accepted").select("entry_id", F.explode(entries).alias("key", "value"))


@query(r"""select entry_id, regexp_extract(record, '"root": "([^"]*)"', 1) as root, regexp_extract(record, '"relative_path": "([^"]*)"', 1) as path, try_cast(nullif(regexp_extract(record,
  '"row_count": ([0-9]+)', 1), '') as bigint) as row_count
from accepted where record is not null""", False)
def text_pins(spark, sf):
    """Identity pins caught from the text of a record by patterns; '' where a pattern finds nothing."""
    pin = lambda p: F.regexp_extract("record", p, 1)
    count = F.nullif(pin('"row_count": ([0-9]+)'), F.lit("")).try_cast("bigint")
    return table(spark, sf, "accepted").where("record is not null").select("entry_id", pin('"root": "([^"]*)"').alias("root"), pin('"relative_path": "([^"]*)"').alias("path"),
        count.alias("row_count"))


@query("""select root, feed, cast(year(date_from_filename) as int) as year, count(*) as files, sha256(string_agg(relative_path || '|' || sha256, chr(10) order by relative_path, sha256)) as identity
from members where relative_path is not null and sha256 is not null group by all""", False)
def inventory_identity(spark, sf):
    """One digest over the sorted archives of a root, feed and year."""
    m = table(spark, sf, "members").where("relative_path is not null and sha256 is not null")
    lines = F.array_sort(F.collect_list(F.struct("relative_path", "sha256")))  # the daily files of one feed and year
    g = m.groupBy("root", "feed", F.year("date_from_filename").alias("year")).agg(F.count("*").alias("files"), lines.alias("l"))
    text = F.array_join(F.transform("l", lambda x: F.concat(x["relative_path"], F.lit("|"), x["sha256"])), "\n")
    return g.select("root", "feed", "year", "files", F.sha2(text, 256).alias("identity"))


@query("""select s.entry_id, m.member_id, m.detected_format from staged_candidates s left join (select file_name, min(member_id) as member_id, min(detected_format) as detected_format from members group by file_name) m on m.file_name = s.file_name""", False)
def named_lookup(spark, sf):
    """The archive of each candidate by its file name, null where none has it."""
    m = table(spark, sf, "members").groupBy("file_name").agg(F.min("member_id").alias("member_id"), F.min("detected_format").alias("detected_format"))
    return table(spark, sf, "staged_candidates").select("entry_id", "file_name").join(m, "file_name", "left").select("entry_id", "member_id", "detected_format")


_INDEX = """, ix as (select file_name, format_family, count(*) as row_count, min(trade_date) as first_date, max(trade_date) as last_date, count(distinct (symbol, series)) as instruments,
  count(*) filter (validity = 'LEN') as invalid_length, count(*) filter (validity = 'CHECKDIGIT') as invalid_checkdigit from rows group by file_name, format_family)"""


def _index(r):
    r = once(r, "validity")
    return r.groupBy("file_name", "format_family").agg(
        F.count("*").alias("row_count"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"), F.countDistinct(F.struct("symbol", "series")).alias("instruments"),
        F.count_if(F.col("validity") == "LEN").alias("invalid_length"), F.count_if(F.col("validity") == "CHECKDIGIT").alias("invalid_checkdigit"),
    )


@query(_INDEX + " select * from ix")
def file_index(spark, sf):
    """Rows, days, instruments and flags of every file."""
    return _index(rows(spark, sf))


@query(_INDEX + """ select format_family, count(*) as files, cast(sum(row_count) as bigint) as row_count, min(first_date) as first_date, max(last_date) as last_date,
  count(*) filter (year(first_date) >= 2024) as added_files, cast(coalesce(sum(row_count) filter (year(first_date) >= 2024), 0) as bigint) as added_rows from ix group by format_family""")
def index_overlay(spark, sf):
    """The index of the base and that of later files composed, and what the later ones brought (their difference)."""
    r = rows(spark, sf)
    late = F.coalesce(F.col("year") >= 2024, F.lit(False))
    side = lambda df, new: _index(df).withColumn("new", F.lit(new))
    both = side(r.where(~late), False).unionByName(side(r.where(late), True))
    return both.groupBy("format_family").agg(
        F.count("*").alias("files"), F.sum("row_count").alias("row_count"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.count_if("new").alias("added_files"), F.coalesce(F.sum(F.when(F.col("new"), F.col("row_count"))), F.lit(0)).alias("added_rows"),
    )


@query("""select case when grouping(root) = 0 then root end as root, grouping(root) = 1 as total, count(*) as files, cast(sum(row_count) as bigint) as row_count,
  count(*) filter (distinct_valid_isin <> valid_isin_rows) as discriminating, count(*) filter (valid_isin_rows + blank_isin_rows + invalid_isin_rows = row_count) as closing,
  case when count(*) filter (valid_isin_rows + blank_isin_rows + invalid_isin_rows <> row_count) = 0 then 'consistent' else 'inconsistent' end as verdict
from file_metrics group by grouping sets ((root), ())""", False)
def metric_verdict(spark, sf):
    """The published figures folded by root and in all, with the verdict on their definition."""
    total = F.col("valid_isin_rows") + F.col("blank_isin_rows") + F.col("invalid_isin_rows")
    g = table(spark, sf, "file_metrics").groupingSets([["root"], []], "root").agg(
        F.grouping("root").alias("_g"), F.count("*").alias("files"), F.sum("row_count").alias("row_count"),
            F.count_if(F.col("distinct_valid_isin") != F.col("valid_isin_rows")).alias("discriminating"),
        F.count_if(total == F.col("row_count")).alias("closing"), F.when(F.count_if(total != F.col("row_count")) == 0, "consistent").otherwise("inconsistent").alias("verdict"),
    )
    return g.withColumn("total", F.col("_g") == 1).drop("_g")


# Pattern of a path, and the class of artifacts it makes.
ARTIFACT_RULES = ((r"^legacy/\d{4}/", "legacy"), (r"^udiff/\d{4}/", "udiff"), (r"\.json\z", "document"), (r"\.parquet\z", "table"))


@query(r"""with r as (select unnest(['legacy', 'udiff', 'document', 'table']) as class, unnest(['^legacy/\d{4}/', '^udiff/\d{4}/', '\.json$', '\.parquet$']) as pattern),
h as (select relative_path, count(r.class) as hits, min(r.class) as class from members left join r on regexp_matches(relative_path, pattern) group by member_id, relative_path)
select case when hits = 1 then class when hits = 0 then 'none' else 'several' end as rule, count(*) as artifacts, bool_and(hits = 1) as exactly_one from h group by 1""", False)
def artifact_rules(spark, sf):
    """How many paths fall under each rule, and those under none or several. The rules are a fixed list, so the pattern join is an array a row."""
    p = F.col("relative_path")
    hits = F.array_compact(F.array(*[F.when(p.rlike(pattern), F.lit(name)) for pattern, name in ARTIFACT_RULES]))
    rule = F.when(F.size(hits) == 1, hits[0]).when(F.size(hits) == 0, "none").otherwise("several")
    return table(spark, sf, "members").select(rule.alias("rule")).groupBy("rule").agg(F.count("*").alias("artifacts"), F.every(~F.col("rule").isin("none", "several")).alias("exactly_one"))


@query("select member_id, root, relative_path, row_number() over (order by root, relative_path, member_id) as sequence from members where root is not null and relative_path is not null", False)
def archive_sequence(spark, sf):
    """The archives numbered by root and path: among those whose paths begin alike, plus the files whose beginnings come before."""
    m = table(spark, sf, "members").where("root is not null and relative_path is not null").select("member_id", "root", "relative_path")
    m = m.withColumn("_folder", F.substring("relative_path", 1, 12))  # a prefix sorts as its paths do
    folders = m.groupBy("root", "_folder").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("root", "_folder").rowsBetween(Window.unboundedPreceding, -1)  # a row a prefix
    folders = folders.select("root", "_folder", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("root", "_folder").orderBy("relative_path", "member_id"))
    return m.withColumn("_at", within).join(folders, ["root", "_folder"]).select("member_id", "root", "relative_path", (F.col("_before") + F.col("_at")).alias("sequence"))


@query(r"""with a as (select entry_id, record->>'root' as root, record->>'relative_path' as relative_path, regexp_replace(lower(trim(digest)), '^sha256:\s*', '') as d from accepted
  where json_valid(record))
select a.entry_id, case when m.member_id is null then 'not-in-inventory' when a.d = m.sha256 then 'digest-agrees' else 'digest-differs' end as state
from a left join members m on m.root = a.root and m.relative_path = a.relative_path""", False)
def inventory_match(spark, sf):
    """Accepted files against the inventory by root and path, with equality of digests."""
    get = lambda k: F.get_json_object("record", f"$.{k}")
    a = table(spark, sf, "accepted").where(F.get_json_object("record", "$").isNotNull())
    a = a.select("entry_id", get("root").alias("root"), get("relative_path").alias("relative_path"), F.regexp_replace(F.lower(F.trim("digest")), r"^sha256:\s*", "").alias("_d"))
    m = table(spark, sf, "members").select("root", "relative_path", "member_id", "sha256")
    state = F.when(F.col("member_id").isNull(), "not-in-inventory").when(F.col("_d") == F.col("sha256"), "digest-agrees").otherwise("digest-differs")
    return a.join(m, ["root", "relative_path"], "left").select("entry_id", state.alias("state"))


# ---- quick views


@query(""", b as (select max(year(date_from_filename)) as y from members)
select n as years, count(*) as row_count, count(*) filter (series = 'EQ') as eq_rows, count(*) filter (sgmt = 'CM') as cm_rows, count(*) filter (series = 'EQ' and sgmt = 'CM') as both_rows
from (select unnest([1, 3, 5, 10]) as n) q, b, rows where year > y - n group by n""")
def quick_filters(spark, sf):
    """The latest 1, 3, 5 and 10 years, counted back from the data, with the quick filters on series and segment."""
    last = table(spark, sf, "members").agg(F.max(F.year("date_from_filename")).alias("y"))
    spans = F.filter(F.array(*[F.lit(n) for n in (1, 3, 5, 10)]), lambda n: F.col("year") > F.col("y") - n)
    eq, cm = F.coalesce(F.col("series") == "EQ", F.lit(False)), F.coalesce(F.col("sgmt") == "CM", F.lit(False))
    # Rows by year first, so that a row is not repeated for every span.
    per = rows(spark, sf).groupBy("year").agg(F.count("*").alias("n"), F.count_if(eq).alias("e"), F.count_if(cm).alias("c"), F.count_if(eq & cm).alias("b")).crossJoin(F.broadcast(last))  # one row
    return per.select(F.explode(spans).alias("years"), "n", "e", "c", "b").groupBy("years").agg(F.sum("n").alias("row_count"), F.sum("e").alias("eq_rows"), F.sum("c").alias("cm_rows"),
        F.sum("b").alias("both_rows"))


@query(r""", o as (select row_id, series, trade_date, member_id, source_line_number, coalesce(series in ('BL', 'BO', 'T0', 'IT', 'IL'), false) or validity not in ('BLANK', 'VALID') as special
  from rows),
a as (select row_id, series, row_number() over (partition by series order by trade_date, member_id, source_line_number, row_id) as n from o),
b as (select row_id, row_number() over (order by trade_date, member_id, source_line_number, row_id) as m from o where special)
select row_id, series, cast(case when n <= 25 then n end as int) as n, cast(case when m <= 200 then m end as int) as special_n from a left join b using (row_id) where n <= 25 or m <= 200""")
def stratified_sample(spark, sf):
    """The first 25 rows of every series and the first 200 special rows (overlays and invalid codes): a sampling operator.

    A hot series is cut to 25 rows a file before it meets in one task.
    """
    order = ["trade_date", "member_id", "source_line_number", "row_id"]
    r = once(rows(spark, sf), "validity").select("row_id", "series", *order[:3], "validity")
    per = r.withColumn("k", F.row_number().over(Window.partitionBy("series", "member_id").orderBy("source_line_number", "row_id"))).where("k <= 25")
    first = per.withColumn("n", F.row_number().over(Window.partitionBy("series").orderBy(*order))).where("n <= 25").select("row_id", "series", "n")
    special = F.coalesce(F.col("series").isin(*OVERLAY_SERIES), F.lit(False)) | ~F.col("validity").isin("BLANK", "VALID")
    top = r.where(special).orderBy(*order).limit(200).withColumn("special_n", F.row_number().over(Window.orderBy(*order))).select(F.col("row_id").alias("_r"), F.col("series").alias("_s"),
        "special_n")  # 200 rows
    j = first.join(top, F.col("row_id") == F.col("_r"), "full")
    return j.select(F.coalesce("row_id", "_r").alias("row_id"), F.coalesce("series", "_s").alias("series"), "n", "special_n")


@query(r""", t as (select *, case when regexp_full_match(price_last, '-?[0-9]+(\.[0-9]+)?') then cast(price_last as decimal(28, 10)) end as p from rows where symbol is not null)
select symbol, trade_date, count(*) as points, count(*) filter (p is null) as omitted, min(p) as low, max(p) as high from t group by symbol, trade_date""")
def price_series(spark, sf):
    """The points of a chart: last prices of a symbol by day, with how many were left out."""
    p = strict_decimal(F.col("price_last"), 28, 10)
    r = rows(spark, sf).where("symbol is not null").withColumn("p", p)
    return r.groupBy("symbol", "trade_date").agg(F.count("*").alias("points"), F.count_if(F.col("p").isNull()).alias("omitted"), F.min("p").alias("low"), F.max("p").alias("high"))


# ---- incremental

_NEW = "year >= 2024"


@query(""", b as (select distinct ticker, series, identity from rows where ticker is not null and identity is not null and coalesce(year < 2024, true)),
d as (select distinct ticker, series, identity from rows where ticker is not null and identity is not null and year >= 2024),
fresh as (select * from d except select * from b),
hit as (select distinct isin_n as i from rows where year >= 2024 and isin_n <> '' union select distinct b.identity from b join fresh f using (ticker, series))
select isin_n, count(*) as row_count, max(trade_date) as last_date, isin_n in (select isin_n from rows where year >= 2024) as touched from rows where isin_n in (select i from hit) group by isin_n""")
def affected_identities(spark, sf):
    """Identities to compute again: those that new rows touch, and those that share a ticker with an identity that is seen under it for the first time."""
    r = rows(spark, sf).where("isin_n <> ''")
    new = F.coalesce(F.expr(_NEW), F.lit(False))
    known = r.where("ticker is not null and identity is not null").groupBy("ticker", "series", "identity").agg(F.max(new).alias("now"), F.max(~new).alias("before"))
    fresh = known.where("now and not before").select("ticker", "series").distinct()
    sharing = known.where("before").join(fresh, ["ticker", "series"], "left_semi").select(F.col("identity").alias("isin_n"))
    touched = r.where(new).select("isin_n").distinct()
    hit = touched.unionByName(sharing).distinct()
    return r.join(hit, "isin_n", "left_semi").groupBy("isin_n").agg(F.count("*").alias("row_count"), F.max("trade_date").alias("last_date"), F.max(new).alias("touched"))


@query(""", c as (select ticker, series, identity, symbol as raw_symbol, case when identity is not null then trade_date end as d, year < 2021 as old from rows where ticker is not null),
m as (select ticker, series, identity, raw_symbol, min(d) as date_from, max(d) as date_to, coalesce(bool_or(old), false) as in_base, coalesce(bool_or(not coalesce(old, false)),
  false) as in_delta from c group by ticker, series, identity, raw_symbol)
select *, in_delta and not in_base as added from m""")
def merge_census(spark, sf):
    """The census of the base merged with that of later rows: bounds over both, and what each brought."""
    r = rows(spark, sf)
    old = F.coalesce(F.col("year") < 2021, F.lit(False))
    keys = ["ticker", "series", "identity", "raw_symbol"]
    base, delta = isl.ticker_census(r.where(old)), isl.ticker_census(r.where(~old))
    merged = isl.merge_census(base, delta)
    side = lambda df, n: df.select(*[F.col(k).alias(f"{n}_{k}") for k in keys], F.lit(True).alias(n))
    same = lambda n: reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{n}_{k}")) for k in keys])
    j = merged.join(side(base, "in_base"), same("in_base"), "left").join(side(delta, "in_delta"), same("in_delta"), "left")
    b, d = F.coalesce("in_base", F.lit(False)), F.coalesce("in_delta", F.lit(False))
    return j.select(*keys, "date_from", "date_to", b.alias("in_base"), d.alias("in_delta"), (d & ~b).alias("added"))


@query(r"""with c as (
  select batch_no, entry_id // 1000 as chunk, count(*) as files, count(*) filter (row_text is null or not regexp_matches(row_text, '\S')) as without_text,
    sha256(string_agg(cast(entry_id as varchar) || '|' || coalesce(digest, ''), chr(10) order by entry_id)) as part from staged_candidates group by all)
select batch_no, cast(sum(files) as bigint) as files, cast(sum(without_text) as bigint) as without_text, sha256(string_agg(part, chr(10) order by chunk)) as seal from c group by batch_no""", False)
def pending_seals(spark, sf):
    """Each pending batch with a digest that changes when anything is added, removed or replaced in it: a digest of the digests of a thousand ids each."""
    lines = F.array_sort(F.collect_list(F.struct("entry_id", F.coalesce("digest", F.lit("")).alias("d"))))  # a thousand at most
    chunk = F.floor(F.col("entry_id") / 1000).alias("chunk")
    c = table(spark, sf, "staged_candidates").groupBy("batch_no", chunk).agg(F.count("*").alias("files"), F.count_if(is_blank(F.col("row_text"))).alias("without_text"), lines.alias("l"))
    part = F.sha2(F.array_join(F.transform("l", lambda x: F.concat(x["entry_id"].cast("string"), F.lit("|"), x["d"])), "\n"), 256)
    g = c.select("batch_no", "files", "without_text", F.struct("chunk", part.alias("part")).alias("s")).groupBy("batch_no").agg(
        F.sum("files").alias("files"), F.sum("without_text").alias("without_text"), F.array_sort(F.collect_list("s")).alias("parts")
    )
    return g.select("batch_no", "files", "without_text", F.sha2(F.array_join(F.transform("parts", lambda x: x["part"]), "\n"), 256).alias("seal"))
