"""Queries of the engine's own operators over the market-data tables; SQL of each beside it.

Parameters are fixed here so that both sides run the same query; `plans.catalog` takes them from
the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import legacy_stamp, short_stamp_pattern, stamp_pattern
from ..functions.isin import validity
from ..functions.numbers import display_number, strict_decimal, strict_integer
from ..functions.text import is_blank, norm
from ..operators import calendar as cal
from ..operators import islands as isl
from ..operators import package
from ..operators.ordering import with_following
from ..schema import OVERLAY_SERIES
from ..session import materialize, new_folder, table
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

# ---- Q1..Q9


@query(""" select case when grouping(format_family) = 0 then format_family end as format_family, case when grouping(year) = 0 then year end as year,
  count(distinct file_name) as files, count(*) as row_count, count(distinct (symbol, series)) as instruments
from rows group by grouping sets ((format_family, year), ())""")
def q1_dataset_summary(spark, sf):
    r = rows(spark, sf)
    pair = F.countDistinct(F.struct("symbol", "series")).alias("instruments")
    return r.groupingSets([["format_family", "year"], []], "format_family", "year").agg(F.countDistinct("file_name").alias("files"), F.count("*").alias("row_count"), pair)


@query(""" select row_id, file_name, source_line_number, trade_date, format_family, symbol, series, isin_n, validity
from rows where trade_date between date '2019-01-01' and date '2020-12-31'""")
def q2_date_range(spark, sf):
    r = rows(spark, sf).where(F.col("trade_date").between("2019-01-01", "2020-12-31"))
    return r.select("row_id", "file_name", "source_line_number", "trade_date", "format_family", "symbol", "series", "isin_n", "validity").orderBy("trade_date", "format_family", "file_name",
        "source_line_number", "row_id")


@query(""", pick as (select ticker, series from rows where ticker is not null group by ticker, series order by count(*) desc, ticker, series limit 1),
ids as (select distinct r.identity from rows r join pick p on r.ticker = p.ticker and r.series = p.series where r.identity is not null)
select r.row_id, r.trade_date, r.symbol, r.series, r.isin_n from rows r join pick p on r.series = p.series
where r.ticker = p.ticker or r.identity in (select identity from ids)""")
def q3_instrument(spark, sf):
    """All rows of a ticker, and of the identities it was seen under, in one series; identities are resolved before anything is filtered."""
    r = rows(spark, sf)
    # The census is small and written once: it gives the parameter and its identities, and the rows are read once more.
    census = materialize(r.where("ticker is not null").groupBy("ticker", "series", "identity").agg(F.count("*").alias("n")))
    pick = census.groupBy("ticker", "series").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ticker", "series").limit(1).select(F.col("ticker").alias("_t"), F.col("series").alias("_s"))
    mine = census.where("identity is not null").join(F.broadcast(pick), (F.col("ticker") == F.col("_t")) & F.col("series").eqNullSafe(F.col("_s"))).select(F.col("identity").alias("_i")).distinct()
    wanted = r.join(F.broadcast(pick), F.col("series") == F.col("_s")).join(mine, F.col("identity") == F.col("_i"), "left")  # one row
    return wanted.where("ticker = _t or _i is not null").select("row_id", "trade_date", "symbol", "series", "isin_n")


@query(""" select row_id, trade_date, symbol, series, sgmt, src, fininstrmtp from rows where series = 'EQ' and sgmt = 'CM' and fininstrmtp = 'STK'""")
def q4_filter(spark, sf):
    wanted = {"series": "EQ", "sgmt": "CM", "fininstrmtp": "STK"}
    return rows(spark, sf).where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in wanted.items()])).select("row_id", "trade_date", "symbol", "series", "sgmt", "src", "fininstrmtp")


_ASSOC = f""", k as (select * from rows where isin_n <> '' and coalesce(series not in {_OV}, true)),
s as (select *, case when row_number() over w > 1 and symbol is not distinct from lag(symbol) over w and series is not distinct from lag(series) over w then 0 else 1 end as st
  from k window w as (partition by isin_n order by trade_date, source_line_number, row_id)),
i as (select *, sum(st) over (partition by isin_n order by trade_date, source_line_number, row_id) as island from s),
a as (select isin_n, cast(island as bigint) as island, symbol, series, min(trade_date) as date_from, max(trade_date) as date_to, count(distinct trade_date) as observed_dates, count(*) as row_count
  from i group by isin_n, island, symbol, series)"""
_CENSUS = """, c as (select ticker, series, identity, symbol as raw_symbol, min(case when identity is not null then trade_date end) as date_from,
  max(case when identity is not null then trade_date end) as date_to from rows where ticker is not null group by ticker, series, identity, symbol)"""


def _keyed(r):
    return r.where((F.col("isin_n") != "") & F.coalesce(~F.col("series").isin(*OVERLAY_SERIES), F.lit(True)))


@query(_ASSOC + " select * from a")
def dated_associations(spark, sf):
    return isl.associations(_keyed(rows(spark, sf)))


@query(_ASSOC + _CENSUS + """ select a.isin_n, a.island, a.symbol, a.series, a.date_from, a.date_to, a.observed_dates, a.row_count, coalesce(string_agg(distinct c.ticker, ',' order by c.ticker),
  '') as tickers
from a left join c on c.identity = a.isin_n and c.series = a.series and c.raw_symbol = a.symbol
  and (c.date_from between a.date_from and a.date_to or c.date_to between a.date_from and a.date_to)
group by all""")
def q5_association(spark, sf):
    r = rows(spark, sf)
    return isl.associations_with_tickers(isl.associations(_keyed(r)), isl.ticker_census(r))


_CAL = """, f as (select date_from_filename as trade_date, detected_format as family, file_name from members),
b as (select min(trade_date) as a, max(trade_date) as z, max(case when family = 'legacy13' then trade_date end) as last_legacy from f),
d as (select cast(unnest(generate_series(cast(a as timestamp), cast(z as timestamp), interval 1 day)) as date) as trade_date, last_legacy from b),
p as (select trade_date, string_agg(distinct family, ',' order by family) as formats, count(*) as members from f group by trade_date),
cal as (select trade_date, strftime(trade_date, '%A') as weekday, members is not null as file_present, formats, coalesce(members, 0) as members,
  members is null and isodow(trade_date) < 6 as missing_weekday,
  case when members is not null then 'not-applicable' when isodow(trade_date) > 5 then 'weekend'
  when last_legacy is null or trade_date <= last_legacy then 'not-retrieved' else 'unexplained' end as label
  from d left join p using (trade_date))"""


def _files(spark, sf):
    return table(spark, sf, "members").select(F.col("date_from_filename").alias("trade_date"), F.col("detected_format").alias("family"), "file_name")


@query(_CAL + """ select count(*) as days, count(*) filter (isodow(trade_date) < 6) as weekdays, count(*) filter (file_present) as file_days,
count(*) filter (missing_weekday) as missing_weekdays, count(*) filter (file_present and isodow(trade_date) > 5) as weekend_files,
count(*) filter (isodow(trade_date) < 6) = count(*) filter (file_present) - count(*) filter (file_present and isodow(trade_date) > 5) + count(*) filter (missing_weekday) as closes from cal""")
def calendar_arithmetic(spark, sf):
    return cal.arithmetic_closes(cal.calendar(_files(spark, sf)))


@query(_CAL + " select label, count(*) as days from cal group by label")
def calendar_labels(spark, sf):
    return cal.arithmetic_by_label(cal.calendar(_files(spark, sf)))


@query(_CAL + " select weekday, count(*) filter (file_present) as file_days from cal group by weekday")
def weekday_histogram(spark, sf):
    return cal.calendar(_files(spark, sf)).groupBy("weekday").agg(F.count_if("file_present").alias("file_days"))


@query(""", t as (select file_name, max(source_line_number) as source_line_number from rows group by file_name)
select r.row_id, r.file_name, r.source_line_number, m.relative_path, m.sha256, x.metric_id, x.row_count as published_rows, m.row_count = x.row_count as rows_agree
from rows r join t using (file_name, source_line_number) join members m on m.file_name = r.file_name left join file_metrics x on x.member_id = m.member_id""")
def q7_record_detail(spark, sf):
    """The last line of every file with its archive and the reconciliation records of that archive."""
    r, m = rows(spark, sf), table(spark, sf, "members")
    last = r.groupBy("file_name").agg(F.max("source_line_number").alias("source_line_number"))
    x = table(spark, sf, "file_metrics").select("member_id", "metric_id", F.col("row_count").alias("published_rows"))
    d = r.select("row_id", "file_name", "source_line_number").join(last, ["file_name", "source_line_number"]).join(m.select("file_name", "relative_path", "sha256", "member_id", "row_count"),
        "file_name").join(x, "member_id", "left")
    return d.select("row_id", "file_name", "source_line_number", "relative_path", "sha256", "metric_id", "published_rows", (F.col("row_count") == F.col("published_rows")).alias("rows_agree"))


_FLAGS = """, fl as (select row_id, 'isin_invalid_length' as flag from rows where validity = 'LEN' union all select row_id, 'isin_invalid_checkdigit' from rows where validity = 'CHECKDIGIT'
  union all select row_id, 'bizdt_ne_traddt' from rows where format_family = 'udiff34' and regexp_matches(raw_biz_dt, '\\S') and raw_biz_dt <> strftime(trade_date,
  '%Y-%m-%d'))""".replace("\\\\", "\\")


def _flagged(r):
    """row_id and the array of flags, sorted by name; flags annotate and never filter."""
    flags = F.array_compact(
        F.array(
            F.when((F.col("format_family") == "udiff34") & F.col("raw_biz_dt").rlike(r"\S") & (F.col("raw_biz_dt") != F.col("trade_date").cast("string")), F.lit("bizdt_ne_traddt")),
            F.when(F.col("validity") == "CHECKDIGIT", F.lit("isin_invalid_checkdigit")),
            F.when(F.col("validity") == "LEN", F.lit("isin_invalid_length")),
        )
    )
    return once(r, "validity").withColumn("flags", flags)


@query(_FLAGS + " select r.row_id, coalesce(string_agg(distinct flag, ', ' order by flag), '') as flag_status from rows r left join fl using (row_id) where validity <> 'VALID' group by r.row_id")
def flag_status(spark, sf):
    r = _flagged(rows(spark, sf).where("validity <> 'VALID'"))
    return r.select("row_id", F.array_join(F.array_sort(F.array_distinct("flags")), ", ").alias("flag_status"))


@query("""select m.member_id, m.root, m.relative_path, m.sha256, count(x.metric_id) as metrics, max(x.row_count) is not distinct from m.row_count as rows_agree
from members m left join file_metrics x on x.root = m.root and x.file_name = m.file_name group by m.member_id, m.root, m.relative_path, m.sha256, m.row_count""", False)
def q9_inventory(spark, sf):
    m = table(spark, sf, "members").select("member_id", "root", "file_name", "relative_path", "sha256", "row_count")
    x = table(spark, sf, "file_metrics").select("root", "file_name", "metric_id", F.col("row_count").alias("_n"))
    g = m.join(x, ["root", "file_name"], "left").groupBy("member_id", "root", "relative_path", "sha256", "row_count").agg(F.count("metric_id").alias("metrics"), F.max("_n").alias("_n"))
    return g.select("member_id", "root", "relative_path", "sha256", "metrics", F.col("_n").eqNullSafe(F.col("row_count")).alias("rows_agree"))


# ---- joins


_LINK = f""", bs as (select member_id, KEY as k, symbol as base_symbol, series as base_series, source_line_number as base_line, quantity as base_quantity,
  row_number() over (partition by member_id, KEY order by source_line_number, row_id) as n, count(*) over (partition by member_id, KEY) as candidates
  from rows where coalesce(series not in {_OV}, true) and KEY <> '')
select o.row_id, o.series, b.base_symbol, b.base_series, b.base_line, b.candidates,
  case when o.quantity is null or base_quantity is null then 'unknown' when o.quantity < base_quantity then 'lt' when o.quantity = base_quantity then 'eq' else 'gt' end as relation
from rows o left join bs b on b.member_id = o.member_id and b.k = o.KEY and b.n = 1 where o.series in {_OV}"""


@query(_LINK.replace("KEY", "isin_n"))
def overlay_link(spark, sf):
    return isl.link_overlays(rows(spark, sf), OVERLAY_SERIES).select("row_id", "series", "base_symbol", "base_series", "base_line", "candidates", "relation")


@query(_LINK.replace("KEY", "symbol"))
def overlay_link_by_symbol(spark, sf):
    return isl.link_overlays(rows(spark, sf), OVERLAY_SERIES, "symbol").select("row_id", "series", "base_symbol", "base_series", "base_line", "candidates", "relation")


@query(_CENSUS + " select * from c")
def ticker_census(spark, sf):
    return isl.ticker_census(rows(spark, sf))


@query(_CENSUS + " select ticker, series, count(distinct identity) as identities from c group by ticker, series having count(distinct identity) > 1")
def shared_tickers(spark, sf):
    return isl.shared_tickers(isl.ticker_census(rows(spark, sf)))


@query(_CENSUS + """, t as (select identity, series, ticker, min(date_from) as s, max(date_to) as e from c where identity is not null group by all)
select a.identity, a.series, a.ticker as ticker_1, b.ticker as ticker_2 from t a join t b on a.identity = b.identity and a.series = b.series and a.ticker < b.ticker and a.s <= b.e and b.s <= a.e""")
def overlapping_tickers(spark, sf):
    return isl.overlapping_tickers(materialize(isl.ticker_census(rows(spark, sf))))


_IVAL = f""", v as (select * from rows where identity is not null and ticker is not null and series is not null and series not in {_OV}),
s as (select *, case when row_number() over w > 1 and ticker = lag(ticker) over w then 0 else 1 end as st from v window w as (partition by identity, series order by trade_date, file_name,
  source_line_number, row_id)),
n as (select *, sum(st) over (partition by identity, series order by trade_date, file_name, source_line_number, row_id) as island from s),
iv as (select identity, series, cast(island as bigint) as island, ticker, min(trade_date) as date_from, max(trade_date) as date_to from n group by identity, series, island, ticker)"""


def _eligible(r):
    # The check digit is worked out once a row; filters that need no identity stay at the scan.
    return once(r.where("ticker is not null and series is not null").where(~F.col("series").isin(*OVERLAY_SERIES)), "identity").where("identity is not null")


@query(_IVAL + " select * from iv")
def ticker_intervals(spark, sf):
    return isl.ticker_intervals(_eligible(rows(spark, sf)))


_UNCLEAR = """, tk as (select identity, series, ticker, min(trade_date) as s, max(trade_date) as e from v group by all),
sh as (select ticker, series from tk group by ticker, series having count(distinct identity) > 1),
un as (select identity, series from tk join sh using (ticker, series)
  union select a.identity, a.series from tk a join tk b on a.identity = b.identity and a.series = b.series and a.ticker < b.ticker and a.s <= b.e and b.s <= a.e)"""


@query(_IVAL + _UNCLEAR + """, o as (select trade_date, row_number() over (order by trade_date) as ordinal from (select distinct date_from_filename as trade_date from members) z
  where trade_date is not null),
x as (select identity, series, ticker as from_ticker, date_to as ended, lead(ticker) over w as to_ticker, lead(date_from) over w as began from iv window w as (partition by identity,
  series order by island))
select identity, series, from_ticker, to_ticker, ended, began, cast(b.ordinal - a.ordinal as int) as gap, case when a.ordinal = b.ordinal then 'SAME_DAY' else 'SEQUENCE' end as kind
from x join o a on a.trade_date = ended join o b on b.trade_date = began where not exists (select 1 from un where un.identity = x.identity and un.series = x.series)""")
def ticker_transitions(spark, sf):
    """Transitions of every group whose tickers are clear: none of them shared with another identity or overlapping another one."""
    r = _eligible(rows(spark, sf))
    return isl.transitions(isl.ticker_intervals(r), isl.day_ordinals(_files(spark, sf)), isl.ambiguous(materialize(isl.ticker_census(r))))


@query(_IVAL + _UNCLEAR + " select identity, series from un")
def ambiguous_groups(spark, sf):
    return isl.ambiguous(materialize(isl.ticker_census(_eligible(rows(spark, sf)))))


@query(_ASSOC + """, o as (select trade_date, row_number() over (order by trade_date) as ordinal from (select distinct date_from_filename as trade_date from members) z where trade_date is not null),
x as (select isin_n, symbol as symbol_before, series as series_before, date_to as last_old_date, lead(symbol) over w as symbol_after, lead(series) over w as series_after,
  lead(date_from) over w as first_new_date
  from a window w as (partition by isin_n order by island))
select x.*, cast(q.ordinal - p.ordinal as int) as gap, symbol_before is distinct from symbol_after and series_before is distinct from series_after as simultaneous,
  case when p.ordinal = q.ordinal then 'SAME_DAY_COEXIST' else 'SEQUENCE' end as kind
from x join o p on p.trade_date = last_old_date join o q on q.trade_date = first_new_date""")
def association_transitions(spark, sf):
    """Every change of symbol or series of a code: the file days between, whether both changed at once, and whether the states share a day."""
    w = Window.partitionBy("isin_n").orderBy("island")  # a row an association
    x = isl.associations(_keyed(rows(spark, sf))).select(
        "isin_n", F.col("symbol").alias("symbol_before"), F.col("series").alias("series_before"), F.col("date_to").alias("last_old_date"),
        F.lead("symbol").over(w).alias("symbol_after"), F.lead("series").over(w).alias("series_after"), F.lead("date_from").over(w).alias("first_new_date"),
    )
    days = isl.day_ordinals(_files(spark, sf))
    old, new = (days.select(F.col("trade_date").alias(c), F.col("ordinal").alias(n)) for c, n in (("last_old_date", "_p"), ("first_new_date", "_q")))
    both = ~F.col("symbol_before").eqNullSafe(F.col("symbol_after")) & ~F.col("series_before").eqNullSafe(F.col("series_after"))
    kind = F.when(F.col("_p") == F.col("_q"), "SAME_DAY_COEXIST").otherwise("SEQUENCE")
    joined = x.join(old, "last_old_date").join(new, "first_new_date")
    return joined.withColumns({"gap": F.col("_q") - F.col("_p"), "simultaneous": both, "kind": kind}).drop("_p", "_q")


@query(f""" select case when series in {_OV} then 'overlay-excluded' when series is null or not regexp_matches(series, '\\S') then 'missing-series' when identity is null then 'missing-identity'
  when ticker is null then 'missing-ticker' else 'eligible' end as route, count(*) as row_count from rows group by 1""")
def continuity_routing(spark, sf):
    route = (
        F.when(F.col("series").isin(*OVERLAY_SERIES), "overlay-excluded").when(is_blank(F.col("series")), "missing-series").when(F.col("identity").isNull(), "missing-identity")
        .when(F.col("ticker").isNull(), "missing-ticker").otherwise("eligible")
    )
    return rows(spark, sf).groupBy(route.alias("route")).agg(F.count("*").alias("row_count"))


@query(""", lg as (select isin_n, arg_min_null(price_close, (trade_date, source_line_number, row_id)) as px from rows where format_family = 'legacy13' and isin_n <> '' group by isin_n),
ud as (select isin_n, arg_min_null(price_prev_close, (trade_date, source_line_number, row_id)) as px from rows where format_family = 'udiff34' and isin_n <> '' group by isin_n)
select coalesce(lg.isin_n, ud.isin_n) as isin_n, case when ud.isin_n is null then 'only_legacy' when lg.isin_n is null then 'only_modern' else 'matched' end as kind,
  lg.px is not distinct from ud.px as same_price from lg full join ud on lg.isin_n = ud.isin_n""")
def cross_format_continuity(spark, sf):
    r = rows(spark, sf).where("isin_n <> ''")
    order = F.struct("trade_date", "source_line_number", "row_id")
    a = r.where("format_family = 'legacy13'").groupBy("isin_n").agg(F.min_by("price_close", order).alias("p0"))
    b = r.where("format_family = 'udiff34'").groupBy(F.col("isin_n").alias("_i")).agg(F.min_by("price_prev_close", order).alias("p1"))
    j = a.join(b, F.col("isin_n") == F.col("_i"), "full")
    kind = F.when(F.col("_i").isNull(), "only_legacy").when(F.col("isin_n").isNull(), "only_modern").otherwise("matched")
    return j.select(F.coalesce("isin_n", "_i").alias("isin_n"), kind.alias("kind"), F.col("p0").eqNullSafe(F.col("p1")).alias("same_price"))


@query("""select count(*) filter (x.member_id is null) as without_metrics, count(*) filter (m.member_id is null) as without_member from members m full join (select distinct member_id from file_metrics) x on x.member_id = m.member_id""", False)
def two_way_check(spark, sf):
    m = table(spark, sf, "members").select("member_id")
    x = table(spark, sf, "file_metrics").select(F.col("member_id").alias("_m")).distinct()
    return m.join(x, F.col("member_id") == F.col("_m"), "full").agg(F.count_if(F.col("_m").isNull()).alias("without_metrics"), F.count_if(F.col("member_id").isNull()).alias("without_member"))


@query("""select d.d as asked, arg_min(m.file_name, (m.date_from_filename, m.file_name)) as file_name, min(m.date_from_filename) as file_date
from (select distinct cast(o_orderdate as date) as d from orders) d left join members m on m.date_from_filename >= d.d and m.date_from_filename < d.d + 31 group by d.d""", False)
def file_as_of(spark, sf):
    """For every asked day the first file on or after it, at most a month later: blocks of the calendar, not a cross join.

    The month is what its SQL asks for; `first_file_on_or_after` searches without a limit.
    """
    asked = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("asked")).distinct()
    # Both sides meet by month, the asked day also in the next one.
    month = lambda c: (F.year(c) * 12 + F.month(c))
    a = asked.select("asked", F.explode(F.array(month(F.col("asked")), month(F.col("asked")) + 1)).alias("m"))
    # The least (date, name) of a day decides, so one row a day is enough.
    f = table(spark, sf, "members").groupBy(F.col("date_from_filename").alias("file_date")).agg(F.min("file_name").alias("file_name")).withColumn("m", month(F.col("file_date")))
    hit = a.join(f, "m").where("file_date >= asked and file_date < date_add(asked, 31)").groupBy("asked").agg(F.min(F.struct("file_date", "file_name")).alias("x"))
    return asked.join(hit, "asked", "left").select("asked", "x.file_name", "x.file_date")


@query("""select d.d as asked, k.k as detected_format, arg_min(m.file_name, (m.date_from_filename, m.file_name)) as file_name, min(m.date_from_filename) as file_date
from (select distinct cast(o_orderdate as date) as d from orders where o_orderdate is not null) d cross join (select distinct detected_format as k from members where detected_format is not null) k
left join members m on m.detected_format = k.k and m.date_from_filename >= d.d group by d.d, k.k""", False)
def first_file_on_or_after(spark, sf):
    """For every asked day and format the first file on or after it, however far away; null only where no such file exists."""
    return select_files(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("asked")), table(spark, sf, "members"))


def select_files(asked, members):
    """asked, detected_format, file_name, file_date. Null days and files without day or format are ignored; of the files of a day the least name counts."""
    files = members.where("date_from_filename is not null and detected_format is not null")
    kinds = members.where("detected_format is not null").select("detected_format").distinct()  # a handful of layouts
    wanted = asked.where("asked is not null").distinct().crossJoin(F.broadcast(kinds)).select("detected_format", F.col("asked").alias("day"), F.lit(True).alias("wanted"),
        F.lit(None).cast("string").alias("file_name"))
    # One row a day and format: what is asked and the day's file.
    days = wanted.unionByName(files.select("detected_format", F.col("date_from_filename").alias("day"), F.lit(False).alias("wanted"), "file_name"))
    days = days.groupBy("detected_format", "day").agg(F.max("wanted").alias("wanted"), F.min("file_name").alias("file_name"))
    hit = F.when(F.col("file_name").isNotNull(), F.struct("file_name", F.col("day").alias("file_date")))
    found = with_following(days.withColumn("hit", hit), "detected_format", F.year("day"), ["day"], "hit").where("wanted")
    return found.select(F.col("day").alias("asked"), "detected_format", "following.file_name", "following.file_date")


# ---- aggregations


_METRICS = r""" select GROUP, count(*) as row_count, count(*) filter (isin_n = '') as blank_isin, count(*) filter (isin_n <> '') as nonblank_isin,
  count(*) filter (symbol is null or not regexp_matches(symbol, '\S')) as blank_symbol,
  count(distinct case when isin_n <> '' then isin_n end) as distinct_isin, count(distinct case when regexp_matches(symbol, '\S') then upper(trim(symbol)) end) as distinct_symbol,
  count(distinct (coalesce(upper(trim(symbol)), ''), coalesce(trim(series), ''))) as pairs, count(*) - count(distinct (coalesce(upper(trim(symbol)), ''), coalesce(trim(series),
  ''))) as pair_duplicates from rows group by GROUP"""


def _metrics(r, *by):
    sym, ser = F.coalesce(F.upper(F.trim("symbol")), F.lit("")), F.coalesce(F.trim("series"), F.lit(""))
    g = r.groupBy(*by).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("isin_n") == "").alias("blank_isin"), F.count_if(F.col("isin_n") != "").alias("nonblank_isin"),
            F.count_if(is_blank(F.col("symbol"))).alias("blank_symbol"),
        F.countDistinct(F.when(F.col("isin_n") != "", F.col("isin_n"))).alias("distinct_isin"), F.countDistinct(F.when(sym != "", sym)).alias("distinct_symbol"), F.countDistinct(F.struct(sym,
            ser)).alias("pairs"),
    )
    return g.withColumn("pair_duplicates", F.col("row_count") - F.col("pairs"))


@query(_METRICS.replace("GROUP", "member_id"))
def row_metrics(spark, sf):
    return _metrics(rows(spark, sf), "member_id")


@query(_METRICS.replace("GROUP", "format_family, year"))
def row_metrics_by_year(spark, sf):
    return _metrics(rows(spark, sf), "format_family", "year")


@query("""select root, count(*) as files, cast(sum(row_count) as bigint) as row_count, cast(sum(blank_isin_rows) as bigint) as blank_isin_rows,
  count(*) filter (distinct_valid_isin <> valid_isin_rows) as discriminating
from file_metrics group by root""", False)
def fold_file_metrics(spark, sf):
    x = table(spark, sf, "file_metrics")
    return x.groupBy("root").agg(F.count("*").alias("files"), F.sum("row_count").alias("row_count"), F.sum("blank_isin_rows").alias("blank_isin_rows"),
        F.count_if(F.col("distinct_valid_isin") != F.col("valid_isin_rows")).alias("discriminating"))


@query(""", d as (select series, format_family, trade_date, count(*) as n from rows group by all)
select series, cast(sum(n) as bigint) as row_count, count(distinct trade_date) as days, min(case when format_family = 'legacy13' then trade_date end) as legacy_first, max(case
  when format_family = 'udiff34' then trade_date end) as modern_last,
  max(n) as most_a_day, case when count(distinct format_family) = 2 then 'shared' when min(format_family) = 'legacy13' then 'legacy-only' else 'modern-only' end as presence from d group by series""")
def series_universe(spark, sf):
    d = rows(spark, sf).groupBy("series", "format_family", "trade_date").agg(F.count("*").alias("n"))
    fam = F.col("format_family")
    return d.groupBy("series").agg(
        F.sum("n").alias("row_count"), F.countDistinct("trade_date").alias("days"), F.min(F.when(fam == "legacy13", F.col("trade_date"))).alias("legacy_first"), F.max(F.when(fam == "udiff34",
            F.col("trade_date"))).alias("modern_last"),
        F.max("n").alias("most_a_day"), F.when(F.countDistinct("format_family") == 2, "shared").when(F.min("format_family") == "legacy13", "legacy-only").otherwise("modern-only").alias("presence"),
    )


@query(""" select sgmt, src, fininstrmtp, series, cast(grouping(sgmt, src, fininstrmtp, series) as int) as level, count(distinct file_name) as files, count(*) as row_count, count(distinct case
  when isin_n <> '' then isin_n end) as distinct_isin,
  count(*) filter (isin_n = '') as blank_isin, min(trade_date) as first_date, max(trade_date) as last_date
from rows where format_family = 'udiff34' group by grouping sets ((sgmt, src, fininstrmtp, series), (sgmt), (src), (fininstrmtp), (series))""")
def census_grouping_sets(spark, sf):
    keys = ["sgmt", "src", "fininstrmtp", "series"]
    g = rows(spark, sf).where("format_family = 'udiff34'").groupingSets([keys, *[[k] for k in keys]], *keys).agg(
        F.grouping_id(*keys).cast("int").alias("level"), F.countDistinct("file_name").alias("files"), F.count("*").alias("row_count"), F.countDistinct(F.when(F.col("isin_n") != "",
            F.col("isin_n"))).alias("distinct_isin"),
        F.count_if(F.col("isin_n") == "").alias("blank_isin"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"),
    )
    return g


@query(""", g as (select file_name, trade_date, count(*) filter (validity = 'BLANK') as blank, count(*) filter (validity not in ('BLANK', 'VALID')) as invalid from rows
  where format_family = 'legacy13' group by all)
select *, greatest(blank, invalid) as worst from g where blank > 0 or invalid > 0 order by worst desc, trade_date, file_name limit 100""")
def top_unusual(spark, sf):
    g = once(rows(spark, sf).where("format_family = 'legacy13'"), "validity").groupBy("file_name", "trade_date").agg(F.count_if(F.col("validity") == "BLANK").alias("blank"),
        F.count_if(~F.col("validity").isin("BLANK", "VALID")).alias("invalid"))
    return g.where("blank > 0 or invalid > 0").withColumn("worst", F.greatest("blank", "invalid")).orderBy(F.desc("worst"), "trade_date", "file_name").limit(100)


@query(""" select year, validity, count(*) as row_count from rows group by year, validity""")
def validity_by_year(spark, sf):
    return rows(spark, sf).groupBy("year", "validity").agg(F.count("*").alias("row_count"))


@query(""", d as (select distinct isin_n, trade_date, series from rows where isin_n <> ''),
g as (select a.series as series_1, b.series as series_2, count(*) as days from d a join d b on a.isin_n = b.isin_n and a.trade_date = b.trade_date and a.series < b.series group by all)
select * from g order by days desc, series_1, series_2 limit 20""")
def series_cooccurrence(spark, sf):
    """Series seen on the same day under one code: pairs within the few distinct series of a code and day."""
    sets = rows(spark, sf).where("isin_n <> '' and series is not null").groupBy("isin_n", "trade_date").agg(F.array_sort(F.collect_set("series")).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda b: F.struct(a.alias("series_1"), b.alias("series_2")))))
    return sets.select(F.explode(pairs).alias("p")).groupBy("p.series_1", "p.series_2").agg(F.count("*").alias("days")).orderBy(F.desc("days"), "series_1", "series_2").limit(20)


@query(_ASSOC + """, t as (select series as from_series, lead(series) over (partition by isin_n order by island) as to_series from a)
select from_series, to_series, count(*) as changes from t where from_series <> to_series group by all""")
def series_transitions(spark, sf):
    a = isl.associations(_keyed(rows(spark, sf)))
    t = a.select(F.col("series").alias("from_series"), F.lead("series").over(Window.partitionBy("isin_n").orderBy("island")).alias("to_series"))
    return t.where("from_series <> to_series").groupBy("from_series", "to_series").agg(F.count("*").alias("changes"))


@query(_ASSOC + """ select isin_n, min(date_from) as first_date, max(date_to) as last_date, count(distinct symbol) as symbols, count(distinct series) as series_count, string_agg(distinct symbol,
  ',' order by symbol) as symbol_list, count(*) as associations,
  count(distinct symbol) = 1 and count(distinct series) = 1 as stable, case when bool_and(isin_n in (select identity from rows where identity is not null)) then true end as valid from a
  group by isin_n""")
def identity_records(spark, sf):
    a = isl.associations(_keyed(rows(spark, sf)))
    return a.groupBy("isin_n").agg(
        F.min("date_from").alias("first_date"), F.max("date_to").alias("last_date"), F.countDistinct("symbol").alias("symbols"), F.countDistinct("series").alias("series_count"),
        F.array_join(F.array_sort(F.collect_set("symbol")), ",").alias("symbol_list"), F.count("*").alias("associations"),
            ((F.countDistinct("symbol") == 1) & (F.countDistinct("series") == 1)).alias("stable"),
    ).withColumn("valid", F.when(validity(F.col("isin_n")) == "VALID", True))


@query(_ASSOC + """, g as (select isin_n, count(distinct symbol) as sy, count(distinct series) as se from a group by isin_n)
select count(*) as identities, count(*) filter (sy > 1) as multi_symbol, count(*) filter (se > 1) as multi_series, count(*) filter (sy = 1 and se = 1) as stable from g""")
def identity_totals(spark, sf):
    g = isl.associations(_keyed(rows(spark, sf))).groupBy("isin_n").agg(F.countDistinct("symbol").alias("sy"), F.countDistinct("series").alias("se"))
    return g.agg(F.count("*").alias("identities"), F.count_if(F.col("sy") > 1).alias("multi_symbol"), F.count_if(F.col("se") > 1).alias("multi_series"),
        F.count_if((F.col("sy") == 1) & (F.col("se") == 1)).alias("stable"))


@query(""", p as (select isin_n, trade_date from rows where isin_n <> '' group by all having count(distinct (symbol, series)) > 1)
select isin_n, count(*) as parallel_days from p group by isin_n""")
def parallel_states(spark, sf):
    p = rows(spark, sf).where("isin_n <> ''").groupBy("isin_n", "trade_date").agg(F.countDistinct(F.struct("symbol", "series")).alias("n")).where("n > 1")
    return p.groupBy("isin_n").agg(F.count("*").alias("parallel_days"))


@query(f""" select member_id, case when series in {_OV} then 'overlay' else 'unkeyed' end as reason, string_agg(distinct series, ',' order by series) as series_list, count(*) as row_count,
  min(source_line_number) as first_line
from rows where series in {_OV} or isin_n = '' group by all""")
def unkeyed_groups(spark, sf):
    over = F.coalesce(F.col("series").isin(*OVERLAY_SERIES), F.lit(False))
    g = rows(spark, sf).where(over | (F.col("isin_n") == "")).groupBy("member_id", F.when(over, "overlay").otherwise("unkeyed").alias("reason"))
    return g.agg(F.nullif(F.array_join(F.array_sort(F.collect_set("series")), ","), F.lit("")).alias("series_list"), F.count("*").alias("row_count"), F.min("source_line_number").alias("first_line"))


@query(""" select symbol, series, arg_min(price_open, (trade_date, source_line_number, row_id)) as first_open, arg_max(price_close, (trade_date, source_line_number, row_id)) as last_close,
  max(close_paise) as high_close, min(close_paise) as low_close, cast(sum(quantity) as bigint) as quantity, count(quantity) as counted from rows where symbol is not null group by symbol, series""")
def period_summary(spark, sf):
    order = F.struct("trade_date", "source_line_number", "row_id")
    has = lambda c: F.when(F.col(c).isNotNull(), order)
    return rows(spark, sf).where("symbol is not null").groupBy("symbol", "series").agg(
        F.min_by("price_open", has("price_open")).alias("first_open"), F.max_by("price_close", has("price_close")).alias("last_close"), F.max("close_paise").alias("high_close"),
            F.min("close_paise").alias("low_close"),
        F.sum("quantity").alias("quantity"), F.count("quantity").alias("counted"),
    )


@query(""", d as (select trade_date, row_number() over (order by trade_date) as a, row_number() over (order by trade_date desc) as z from (select distinct trade_date from rows) q),
g as (select series, count(*) filter (a <= 25) as early, count(*) filter (z <= 25) as late from rows join d using (trade_date) where series is not null group by series)
select *, abs(late - early) as delta from g where early + late > 0""")
def distribution_shift(spark, sf):
    """Rows of a series on the first and the last 25 file days, as its SQL asks for; `format_shift` compares the formats."""
    r = rows(spark, sf).groupBy("series", "trade_date").agg(F.count("*").alias("n"))
    days = isl.day_ordinals(r)
    d = days.crossJoin(F.broadcast(days.agg(F.max("ordinal").alias("_most")))).select("trade_date", F.col("ordinal").alias("a"), (F.col("_most") + 1 - F.col("ordinal")).alias("z"))  # one row
    part = lambda c: F.coalesce(F.sum(F.when(c <= 25, F.col("n"))), F.lit(0))
    g = r.where("series is not null").join(d, "trade_date").groupBy("series").agg(part(F.col("a")).alias("early"), part(F.col("z")).alias("late"))
    return g.where("early + late > 0").withColumn("delta", F.abs(F.col("late") - F.col("early")))


@query(""", f as (select distinct detected_format as k, date_from_filename as d from members where date_from_filename is not null and detected_format in ('legacy13', 'udiff34')),
w as (select k, d from (select k, d, row_number() over (partition by k order by case when k = 'legacy13' then -epoch(d) else epoch(d) end) as n from f) z where n <= 250),
c as (select k, count(*) as days from w group by k), s as (select k, series, count(*) as n from rows join w on k = format_family and d = trade_date where series is not null group by k, series),
a as (select series, n / days as v from s join c using (k) where k = 'legacy13'), b as (select series, n / days as v from s join c using (k) where k = 'udiff34')
select coalesce(a.series, b.series) as series, coalesce(a.v, 0) as legacy_average, coalesce(b.v, 0) as modern_average, coalesce(b.v, 0) - coalesce(a.v, 0) as delta from a full
  join b on a.series = b.series""")
def format_shift(spark, sf):
    """Average rows a day of a series over the last 250 legacy and the first 250 modern file days."""
    return shift(rows(spark, sf), table(spark, sf, "members"))


def shift(r, members, days=250):
    """series, legacy_average, modern_average, delta, of every series that either side has. A file day without rows counts as a day; a null series is left out."""
    kind, day = F.col("detected_format"), F.unix_date("date_from_filename")
    f = members.where("date_from_filename is not null").where(kind.isin("legacy13", "udiff34")).select("detected_format", "date_from_filename").distinct()
    # One row a day of the calendar and format.
    nearest = Window.partitionBy("detected_format").orderBy(F.when(kind == "legacy13", -day).otherwise(day))
    f = f.withColumn("k", F.row_number().over(nearest)).where(F.col("k") <= days).select(kind.alias("format_family"), F.col("date_from_filename").alias("trade_date"))
    of = lambda k: F.col("format_family") == k
    counted = f.agg(F.count_if(of("legacy13")).alias("d0"), F.count_if(of("udiff34")).alias("d1"))  # one row
    n = r.where("series is not null").join(f, ["format_family", "trade_date"]).groupBy("series").agg(F.count_if(of("legacy13")).alias("n0"),
        F.count_if(of("udiff34")).alias("n1")).crossJoin(F.broadcast(counted))
    average = lambda n, d: F.coalesce(F.try_divide(F.col(n), F.col(d)), F.lit(0.0))
    n = n.select("series", average("n0", "d0").alias("legacy_average"), average("n1", "d1").alias("modern_average"))
    return n.withColumn("delta", F.col("modern_average") - F.col("legacy_average"))


@query(r""", t as (select format_family, cast(tottrdval as double) / quantity / (close_paise / 100.0) as x from rows where regexp_full_match(tottrdval, '[0-9]+(\.[0-9]+)?') and quantity > 0
  and close_paise > 0)
select format_family, count(*) as tested, count(*) filter (abs(x - 1) < 0.02) as rupees, count(*) filter (abs(x * 1e5 - 1) < 0.02) as lakhs from t group by format_family""")
def unit_scale(spark, sf):
    x = F.col("v") / F.col("quantity") / (F.col("close_paise") / 100.0)
    t = rows(spark, sf).withColumn("v", F.when(F.col("tottrdval").rlike(r"^[0-9]+(\.[0-9]+)?\z"),
        F.col("tottrdval").try_cast("double"))).where("v is not null and quantity > 0 and close_paise > 0").withColumn("x", x)
    return t.groupBy("format_family").agg(F.count("*").alias("tested"), F.count_if(F.abs(F.col("x") - 1) < 0.02).alias("rupees"), F.count_if(F.abs(F.col("x") * 1e5 - 1) < 0.02).alias("lakhs"))


@query(""", l as (select distinct series from rows where format_family = 'legacy13' and series is not null), u as (select distinct series from rows
  where format_family = 'udiff34' and series is not null)
select 'shared' as part, series from (select * from l intersect select * from u) a union all select 'legacy-only', series from (select * from l except select * from u) b
  union all select 'modern-only', series from (select * from u except select * from l) c""")
def series_sets(spark, sf):
    r = rows(spark, sf).where("series is not null")
    a, b = (r.where(F.col("format_family") == f).select("series").distinct() for f in ("legacy13", "udiff34"))
    tag = lambda df, p: df.select(F.lit(p).alias("part"), "series")
    return tag(a.intersect(b), "shared").unionByName(tag(a.subtract(b), "legacy-only")).unionByName(tag(b.subtract(a), "modern-only"))


@query(""", e as (select (select max(date_from_filename) from members where detected_format = 'legacy13') as l, (select min(date_from_filename) from members where detected_format = 'udiff34') as u),
a as (select series, count(*) as last_legacy from rows, e where trade_date = l and format_family = 'legacy13' and series is not null group by series), b as (select series,
  count(*) as first_modern from rows, e where trade_date = u and format_family = 'udiff34' and series is not null group by series)
select coalesce(a.series, b.series) as series, coalesce(last_legacy, 0) as last_legacy, coalesce(first_modern, 0) as first_modern from a full join b on a.series = b.series""")
def series_boundary(spark, sf):
    """Rows of each series on the last legacy and the first modern day."""
    r, m = rows(spark, sf).where("series is not null"), table(spark, sf, "members")
    e = m.agg(F.max(F.when(F.col("detected_format") == "legacy13", F.col("date_from_filename"))).alias("l"), F.min(F.when(F.col("detected_format") == "udiff34",
        F.col("date_from_filename"))).alias("u"))
    j = r.join(F.broadcast(e), ((F.col("trade_date") == F.col("l")) & (F.col("format_family") == "legacy13")) | ((F.col("trade_date") == F.col("u")) & (F.col("format_family") == "udiff34")))  # one row
    return j.groupBy("series").agg(F.count_if(F.col("format_family") == "legacy13").alias("last_legacy"), F.count_if(F.col("format_family") == "udiff34").alias("first_modern"))


@query(""", g as (select file_name, feed, trade_date, count(*) filter (validity not in ('BLANK', 'VALID')) as invalid, dense_rank() over (partition by feed order by trade_date) as k from rows
  group by file_name, feed, trade_date),
t as (select feed, arg_max(k, (invalid, -k)) as mid from g group by feed)
select g.feed, file_name, trade_date, invalid, cast(k - mid as int) as distance from g join t using (feed) where abs(k - mid) <= 3""")
def anomaly_windows(spark, sf):
    """The files around the worst file of each feed, three days to either side."""
    g = rows(spark, sf).groupBy("file_name", "feed", "trade_date").agg(F.count_if(~F.col("validity").isin("BLANK", "VALID")).alias("invalid"))
    g = g.withColumn("k", F.dense_rank().over(Window.partitionBy("feed").orderBy("trade_date")))
    t = g.groupBy("feed").agg(F.max_by("k", F.struct("invalid", -F.col("k"))).alias("at"))
    return g.join(t, "feed").where("abs(k - at) <= 3").select("feed", "file_name", "trade_date", "invalid", (F.col("k") - F.col("at")).alias("distance"))


@query("select detected_format, header_width, count(*) as files, count(distinct sha256) as digests from members group by all", False)
def header_widths(spark, sf):
    return table(spark, sf, "members").groupBy("detected_format", "header_width").agg(F.count("*").alias("files"), F.countDistinct("sha256").alias("digests"))


@query("select 'sha256' as kind, sha256 as value, count(*) as n from members group by sha256 having count(*) > 1 union all select 'feed date', feed || ' ' || date_from_filename, count(*) from members group by feed, date_from_filename having count(*) > 1", False)
def inventory_conflicts(spark, sf):
    m = table(spark, sf, "members")
    a = m.groupBy(F.col("sha256").alias("value")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("sha256").alias("kind"), "value", "n")
    b = m.groupBy(F.concat_ws(" ", "feed", F.col("date_from_filename").cast("string")).alias("value")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("feed date").alias("kind"),
        "value", "n")
    return a.unionByName(b)


@query("select count(*) as files, count(distinct root) as roots, count(*) - count(distinct sha256) as repeated_digests, min(date_from_filename) as first_date, max(date_from_filename) as last_date, cast(sum(size_bytes) as bigint) as bytes, count(*) filter (row_count is null) as unknown_rows from members", False)
def inventory_summary(spark, sf):
    return table(spark, sf, "members").agg(
        F.count("*").alias("files"), F.countDistinct("root").alias("roots"), (F.count("*") - F.countDistinct("sha256")).alias("repeated_digests"), F.min("date_from_filename").alias("first_date"),
        F.max("date_from_filename").alias("last_date"), F.sum("size_bytes").alias("bytes"), F.count_if(F.col("row_count").isNull()).alias("unknown_rows"),
    )


@query(""" select year, format_family, count(*) as row_count from rows group by all""")
def rows_by_year(spark, sf):
    return rows(spark, sf).groupBy("year", "format_family").agg(F.count("*").alias("row_count"))


@query(""", g as (select file_name, series, count(*) as n from rows where series is not null group by all)
select series, count(*) as archives, cast(sum(n) as bigint) as row_count from g group by series""")
def segment_counts(spark, sf):
    """Archives and rows of each series, from a map of counts by file."""
    g = rows(spark, sf).where("series is not null").groupBy("file_name", "series").agg(F.count("*").alias("n"))
    maps = g.groupBy("file_name").agg(F.map_from_entries(F.collect_list(F.struct("series", "n"))).alias("series_counts"))  # as many entries as a file has series
    return maps.select(F.explode("series_counts").alias("series", "n")).groupBy("series").agg(F.count("*").alias("archives"), F.sum("n").alias("row_count"))


@query(""", g as (select file_name, year, series, count(*) as n from rows where series is not null group by all)
select file_name, string_agg(series, '+' order by series) as label, cast(sum(n) as bigint) as row_count from g group by file_name,
  year having bool_or(series = 'GB') and lower(file_name) like '%bhav%'""")
def archive_search(spark, sf):
    g = rows(spark, sf).where(F.lower("file_name").contains("bhav") & F.col("series").isNotNull()).groupBy("file_name", "series").agg(F.count("*").alias("n"))
    maps = g.groupBy("file_name").agg(F.map_from_entries(F.collect_list(F.struct("series", "n"))).alias("m"))
    hit = maps.where(F.array_contains(F.map_keys("m"), "GB"))
    return hit.select("file_name", F.array_join(F.array_sort(F.map_keys("m")), "+").alias("label"), F.aggregate(F.map_values("m"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("row_count"))


@query(""" select year, count(*) as row_count from rows where year > (select max(year(date_from_filename)) from members) - 3 group by year""")
def latest_years(spark, sf):
    """The latest three years, counted back from the data and not from the clock."""
    last = table(spark, sf, "members").agg(F.max(F.year("date_from_filename")).alias("y"))
    return rows(spark, sf).join(F.broadcast(last), F.col("year") > F.col("y") - 3).groupBy("year").agg(F.count("*").alias("row_count"))  # one row


@query(r""" select symbol, count(*) as points, count(*) filter (price_last is null or not regexp_full_match(price_last, '[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?')) as omitted from rows where symbol is not null group by symbol""")
def price_points(spark, sf):
    return rows(spark, sf).where("symbol is not null").groupBy("symbol").agg(F.count("*").alias("points"), F.count_if(display_number(F.col("price_last")).isNull()).alias("omitted"))


@query(r"""select count(*) as row_count, count(*) filter (regexp_full_match(price_open, '-?[0-9]+(\.[0-9]+)?')) as decimals, count(*) filter (regexp_full_match(totaltrades, '-?[0-9]+')) as integers,
  cast(sum(case when regexp_full_match(totaltrades, '-?[0-9]+') then cast(totaltrades as bigint) end) as bigint) as trades, cast(sum(case when regexp_full_match(price_open,
  '-?[0-9]+(\.[0-9]+)?') then cast(round(cast(price_open as decimal(28, 10)) * 100) as bigint) end) as bigint) as open_paise from price_rows""", False)
def typed_values(spark, sf):
    p = table(spark, sf, "price_rows")
    d, i = strict_decimal(F.col("price_open")), strict_integer(F.col("totaltrades"))
    return p.agg(F.count("*").alias("row_count"), F.count(d).alias("decimals"), F.count(i).alias("integers"), F.sum(i).alias("trades"), F.sum(F.round(d * 100, 0).cast("bigint")).alias("open_paise"))


@query(""" select isin_n, validity, count(*) as row_count from rows group by isin_n, validity""")
def isin_validity(spark, sf):
    return rows(spark, sf).groupBy("isin_n", "validity").agg(F.count("*").alias("row_count"))


@query(r""" select failure, count(*) as row_count from (select case when raw_biz_dt = '' then 'legacy_timestamp_blank' when regexp_full_match(raw_biz_dt,
  '\d\d-[A-Za-z]{3}-\d{4}') and try_strptime(raw_biz_dt, '%d-%b-%Y') is not null then 'none'
  when regexp_full_match(raw_biz_dt, '\d\d-[A-Za-z]{3}-\d\d') then 'short' else 'legacy_timestamp_unparseable' end as failure from rows
  where format_family = 'legacy13' and raw_biz_dt is not null) z group by failure""")
def legacy_timestamps(spark, sf):
    s = F.col("raw_biz_dt")
    f = F.when(s.rlike(rf"^{short_stamp_pattern()}\z"), "short").otherwise(F.coalesce(legacy_stamp(s, F.col("trade_date"))["failure"], F.lit("none")))
    return rows(spark, sf).where((F.col("format_family") == "legacy13") & s.isNotNull()).groupBy(f.alias("failure")).agg(F.count("*").alias("row_count"))


@query(r""" select member_id, bool_and(regexp_matches(raw_biz_dt, '\S')) as compared, bool_and(raw_biz_dt is not distinct from strftime(trade_date, '%Y-%m-%d')) as equal from rows where format_family = 'udiff34' group by member_id""")
def date_facts(spark, sf):
    r = rows(spark, sf).where("format_family = 'udiff34'")
    return r.groupBy("member_id").agg(F.every(F.col("raw_biz_dt").rlike(r"\S")).alias("compared"), F.every(F.col("raw_biz_dt").eqNullSafe(F.col("trade_date").cast("string"))).alias("equal"))


_LINK2 = _LINK.split("select o.row_id")[0].replace(", bs as", ", B as")


@query(_LINK2.replace("B as", "bi as").replace("KEY", "isin_n") + _LINK2.replace("B as", "bs as").replace("KEY", "symbol") + f"""
select o.row_id, coalesce(i.base_line, s.base_line) as base_line, case when i.k is not null then 'BASE_BY_ISIN' when s.k is not null then 'BASE_BY_SYMBOL_ONLY' else 'ORPHAN' end as match_type
from rows o left join bi i on i.member_id = o.member_id and i.k = o.isin_n and i.n = 1 left join bs s on s.member_id = o.member_id and s.k = o.symbol and s.n = 1 where o.series in {_OV}""")
def overlay_two_stage(spark, sf):
    """Overlay rows linked by code, and by symbol where the code has no base."""
    r = rows(spark, sf)
    by = lambda k, n: isl.link_overlays(r, OVERLAY_SERIES, k).select("row_id", F.col("base_line").alias(f"l{n}"), F.col("candidates").alias(f"c{n}"))
    j = by("isin_n", 1).join(by("symbol", 2), "row_id")
    kind = F.when(F.col("c1").isNotNull(), "BASE_BY_ISIN").when(F.col("c2").isNotNull(), "BASE_BY_SYMBOL_ONLY").otherwise("ORPHAN")
    return j.select("row_id", F.coalesce("l1", "l2").alias("base_line"), kind.alias("match_type"))


@query(""", n as (select member_id, count(distinct source_line_number) as lines from rows group by member_id)
select m.row_count - n.lines as residual, count(*) as files from members m join n using (member_id) where m.row_count is not null group by 1""")
def deficit_residuals(spark, sf):
    n = rows(spark, sf).groupBy("member_id").agg(F.countDistinct("source_line_number").alias("lines"))
    m = table(spark, sf, "members").where("row_count is not null").select("member_id", "row_count")
    return m.join(n, "member_id").groupBy((F.col("row_count") - F.col("lines")).alias("residual")).agg(F.count("*").alias("files"))


@query(""", d as (select distinct member_id, source_line_number, series from rows), g as (select member_id, coalesce(series, '') as s, count(*) as n from d group by all)
select m.member_id, cast(sum(n) as bigint) as series_total, cast(sum(n) as bigint) is not distinct from max(m.row_count) as sums_up from g join members m using (member_id) group by m.member_id""")
def series_map_sums(spark, sf):
    """Whether the counts by series of a file add up to its row count."""
    d = rows(spark, sf).select("member_id", "source_line_number", "series").distinct().groupBy("member_id", F.coalesce("series", F.lit("")).alias("s")).agg(F.count("*").alias("n"))
    maps = d.groupBy("member_id").agg(F.map_from_entries(F.collect_list(F.struct("s", "n"))).alias("m"))  # as many entries as a file has series
    total = F.aggregate(F.map_values("m"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return maps.join(table(spark, sf, "members").select("member_id", "row_count"), "member_id").select("member_id", total.alias("series_total"), total.eqNullSafe(F.col("row_count")).alias("sums_up"))


@query(r""", x as (select m.member_id, m.header_width, m.file_name, count(*) filter (r.series = 'BL') as bl, count(*) as n, count(distinct r.isin_n) as isins from members m
  join rows r using (member_id) group by all)
select member_id, header_width, bl, header_width = 13 as short_header, regexp_matches(file_name, '(?i)31(dec|jan)') as year_end, bl > 0 and n = isins as overlay_without_repeats from x
  where header_width = 13 or regexp_matches(file_name, '(?i)31(dec|jan)') or (bl > 0 and n = isins)""")
def inventory_anomalies(spark, sf):
    m = table(spark, sf, "members").select("member_id", "header_width")
    g = rows(spark, sf).groupBy("member_id", "file_name").agg(F.count_if(F.col("series") == "BL").alias("bl"), F.count("*").alias("n"), F.countDistinct("isin_n").alias("isins"))
    x = m.join(g, "member_id").select("member_id", "header_width", "bl", (F.col("header_width") == 13).alias("short_header"), F.col("file_name").rlike("(?i)31(dec|jan)").alias("year_end"),
        ((F.col("bl") > 0) & (F.col("n") == F.col("isins"))).alias("overlay_without_repeats"))
    return x.where("short_header or year_end or overlay_without_repeats")


@query("""select relative_path, size_bytes, cast(rank as int) as rank from (select relative_path, size_bytes, row_number() over (order by size_bytes desc, relative_path) as rank from members) z where rank between 11 and 20""", False)
def inventory_page(spark, sf):
    """The second page of ten of the inventory by size: a page is a top-k of its end, numbered afterwards."""
    top = table(spark, sf, "members").select("relative_path", "size_bytes").orderBy(F.desc("size_bytes"), "relative_path").limit(20)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("size_bytes"), "relative_path"))).where("rank > 10")


@query("""select extract(isodow from date_from_filename) > 5 as weekend, count(*) as files, count(distinct date_from_filename) as days from members group by 1""", False)
def weekend_files(spark, sf):
    return table(spark, sf, "members").groupBy((F.weekday("date_from_filename") >= 5).alias("weekend")).agg(F.count("*").alias("files"), F.countDistinct("date_from_filename").alias("days"))


@query(""", t as (select upper(trim(ticker)) as ticker, upper(trim(series)) as series, upper(trim(identity)) as identity, date_from, date_to from tickers
  where ticker is not null and series is not null and identity is not null and date_from <= coalesce(date_to, '2026-09-18')),
c as (select ticker, series, count(distinct identity) as identities, min(date_from) as first_from, max(coalesce(date_to, '2026-09-18')) as last_to from t group by ticker, series) select * from c""")
def ticker_bounds(spark, sf):
    t = table(spark, sf, "tickers").where("ticker is not null and series is not null and identity is not null").withColumn("date_to", F.coalesce("date_to",
        F.lit("2026-09-18"))).where("date_from <= date_to")
    return t.groupBy(F.upper(F.trim("ticker")).alias("ticker"), F.upper(F.trim("series")).alias("series")).agg(F.countDistinct(F.upper(F.trim("identity"))).alias("identities"),
        F.min("date_from").alias("first_from"), F.max("date_to").alias("last_to"))


# ---- incremental


@query(r"""select s.entry_id, case when a.entry_id is null then 'new' when regexp_replace(lower(trim(a.digest)), '^sha256:', '') = regexp_replace(lower(trim(s.digest)), '^sha256:',
  '') then 'unchanged' else 'changed' end as state
from staged_candidates s left join accepted a on a.file_name = s.file_name and a.date = s.date""", False)
def pending_queue(spark, sf):
    return arrivals_state(table(spark, sf, "staged_candidates"), table(spark, sf, "accepted")).select("entry_id", "state")


def arrivals_state(staged, accepted):
    d = lambda c: F.regexp_replace(F.lower(F.trim(c)), "^sha256:", "")
    a = accepted.select("file_name", "date", F.col("entry_id").alias("_id"), d("digest").alias("_d"))
    state = F.when(F.col("_id").isNull(), "new").when(F.col("_d") == d("digest"), "unchanged").otherwise("changed")
    return staged.join(a, ["file_name", "date"], "left").withColumn("state", state)


@query(r""", b as (select isin_n, max(symbol) as symbol from rows where year < 2022 and isin_n <> '' group by isin_n), o as (select isin_n, max(symbol) as symbol from rows
  where year >= 2022 and isin_n <> '' group by isin_n)
select * from o union all select * from b where isin_n not in (select isin_n from o)""")
def overrides(spark, sf):
    r = rows(spark, sf).where("isin_n <> ''")
    g = lambda c: r.where(c).groupBy("isin_n").agg(F.max("symbol").alias("symbol"))
    new = g("year >= 2022")
    return new.unionByName(g("year < 2022").join(new.select("isin_n"), "isin_n", "left_anti"))


@query(""", g as (select format_family, year, count(*) as a, count(*) filter (loaded_at < timestamp '2024-01-01') as b from rows group by all)
select case when b = 0 then 'missing' else 'different' end as kind, format_family, cast(year as varchar) as year from g where a <> b""")
def replay_compare(spark, sf):
    """Two packages, of all rows and of those loaded before 2024, written and compared by their content: every partition in which they differ."""
    r = rows(spark, sf).select("row_id", "format_family", "year", "member_id", "source_line_number", "symbol", "series", "isin", "tottrdqty", "tottrdval", "price_close", "raw_biz_dt", "loaded_at")
    by, states = ["format_family", "year"], []
    for df in (r, r.where("loaded_at < timestamp_ntz '2024-01-01'")):
        path = new_folder(spark)
        package.write_package(df, path, by)
        states.append(spark.read.parquet(f"{path}/manifest"))
    return package.compare(*states, by)


@query(r"""select feed, upper(regexp_replace(sctysrs, '^\s+|\s+$', '', 'g')) as series, count(*) as groups, cast(sum(row_count) as bigint) as row_count, count(*) filter (first_date > last_date) as reversed from ud_census_groups group by all""", False)
def published_census(spark, sf):
    return table(spark, sf, "ud_census_groups").groupBy("feed", norm(F.col("sctysrs")).alias("series")).agg(F.count("*").alias("groups"), F.sum("row_count").alias("row_count"),
        F.count_if(F.col("first_date") > F.col("last_date")).alias("reversed"))


# ---- star schema


@query("""select o_orderstatus, case when grouping(y) = 0 then y end as year, count(*) as orders, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents
from (select *, cast(year(o_orderdate) as int) as y from orders) o group by grouping sets ((o_orderstatus, y), (o_orderstatus))""", False)
def order_rollup(spark, sf):
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return o.groupingSets([["o_orderstatus", "year"], ["o_orderstatus"]], "o_orderstatus", "year").agg(F.count("*").alias("orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


@query("""select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents, count(*) as lines from lineitem where l_shipdate <= timestamp '1998-09-02' group by all""", False)
def line_summary(spark, sf):
    x = table(spark, sf, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"), F.count("*").alias("lines"))


@query("""with s as (select user_id, ts, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as p from events) select p as from_type, event_type as to_type, count(*) as n from s where p is not null and p <> event_type group by all""", False)
def event_transitions(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").select("event_type", F.lag("event_type").over(w).alias("from_type")).where("from_type <> event_type")
    return e.groupBy("from_type", F.col("event_type").alias("to_type")).agg(F.count("*").alias("n"))


@query("""select cast(date_trunc('hour', ts) as timestamp) as hour, event_type, count(*) as n from events group by all""", False)
def event_windows(spark, sf):
    return table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("n"))
