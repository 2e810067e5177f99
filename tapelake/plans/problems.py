"""Queries of the general problems: p1, p2, p4, p5, p6, p7."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, history, intervals, profile, quarantine, units
from ..schema import FIELD_MAP, LAYOUTS, LEGACY, UDIFF
from ..session import materialize, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_N = r"upper(regexp_replace({}, '^\s+|\s+$', '', 'g'))"
_BLANK = r"({0} is null or regexp_full_match({0}, '\s*'))"


@query(rf"""
with o as (
  select {_N.format("identity")} as identity, {_N.format("ticker")} as ticker, {_N.format("series")} as series,
         cast(date_from as date) as f, cast(coalesce(date_to, '2026-09-18') as date) as t, loaded_at, obs_id
  from tickers where identity is not null and ticker is not null and series is not null and date_from is not null),
d as (
  select identity, d, arg_max(ticker, (loaded_at, obs_id)) as ticker, arg_max(series, (loaded_at, obs_id)) as series
  from (select *, unnest(generate_series(cast(f as timestamp), cast(t as timestamp), interval 1 day)) as d from o where f <= t) x group by identity, d),
l as (
  select *, case when lag(ticker) over w is distinct from ticker or lag(series) over w is distinct from series then 1 else 0 end as s
  from d window w as (partition by identity order by d)),
r as (select *, sum(s) over (partition by identity order by d) as i from l)
select identity, ticker, series, strftime(min(d), '%Y-%m-%d') as date_from, strftime(max(d), '%Y-%m-%d') as date_to
from r group by identity, i, ticker, series""")
def p1_found(spark, sf):
    return history.ticker_history(table(spark, sf, "tickers"))


@query(rf"""
with o as (
  select {_N.format("identity")} as identity, {_N.format("ticker")} as ticker, {_N.format("series")} as series,
         cast(date_from as date) as f, cast(coalesce(date_to, '2026-09-18') as date) as t, loaded_at, obs_id
  from tickers where identity is not null and ticker is not null and series is not null and date_from is not null),
d as (
  select identity, d, arg_max(ticker, (loaded_at, obs_id)) as ticker, arg_max(series, (loaded_at, obs_id)) as series
  from (select *, unnest(generate_series(cast(f as timestamp), cast(t as timestamp), interval 1 day)) as d from o where f <= t) x group by identity, d),
v as (select identity, d, unnest(['ticker', 'series']) as satellite, unnest([ticker, series]) as value from d),
l as (select *, value is distinct from lag(value) over (partition by identity, satellite order by d) as starts from v)
select identity, satellite, count(*) as versions, cast(max(d) as date) as latest_from from l where starts group by identity, satellite""")
def p1_satellites(spark, sf):
    """Rows of every insert-only satellite by identity, and when the latest was appended."""
    sats = history.satellites(history.resolve_spans(history.observations(table(spark, sf, "tickers")), ["ticker", "series"]), history.GROUPS)
    return sats.where("satellite <> ''").groupBy(F.col("key").alias("identity"), "satellite").agg(F.count("*").alias("versions"), F.date_from_unix_date(F.max("valid_from")).alias("latest_from"))


@query(rf"""
with o as (
  select {_N.format("identity")} as identity, cast(date_from as date) as f, cast(coalesce(date_to, '2026-09-18') as date) as t
  from tickers where identity is not null and date_from is not null),
l as (select *, max(t) over (partition by identity order by f, t rows between unbounded preceding and 1 preceding) as m from o where f <= t),
r as (select *, sum(case when m is null or f > m + 1 then 1 else 0 end) over (partition by identity order by f, t) as i from l),
p as (select identity, min(f) as f, max(t) as t from r group by identity, i),
g as (select identity, t + 1 as f, lead(f) over (partition by identity order by f) - 1 as t from p)
select identity, 'period' as kind, strftime(f, '%Y-%m-%d') as date_from, strftime(t, '%Y-%m-%d') as date_to from p
union all select identity, 'gap', strftime(f, '%Y-%m-%d'), strftime(t, '%Y-%m-%d') from g where t is not null""")
def p2_found(spark, sf):
    return intervals.ticker_periods(table(spark, sf, "tickers"))


_F = '(?:"(?:[^"]|"")*"|[^",][^,]*|)'
_DEC, _INT = r"(-?[0-9]+(\.[0-9]+)?)?", r"(-?[0-9]+)?"


_LINES = rf"""
with l as (
  select record_id, member_id, line_number, raw_line, coalesce(raw_line, '') as line, detected_format as fmt, header_width as w, date_from_filename as day
  from raw_records left join members using (member_id)),
s as (select *, regexp_full_match(line, '{_F}(,{_F})*') as ok from l),
f as (select *, case when ok and line <> '' then list_transform(regexp_extract_all(line || ',', '({_F}),', 1),
        lambda x: case when x like '"%' then replace(substr(x, 2, length(x) - 2), '""', '"') else x end) else [] end as v from s),
t as (
  select *, case when fmt = 'legacy13' then v[11] else v[1] end as d,
    case when fmt = 'legacy13' then [v[3], v[4], v[5], v[6], v[7], v[8], v[10]] else [v[15], v[16], v[17], v[18], v[19], v[20], v[26]] end as decs,
    case when fmt = 'legacy13' then [v[9], v[12]] else [v[25], v[27]] end as ints from f),
u as (
  select *, regexp_full_match(d, '\d\d-[A-Za-z]{{3}}-\d{{4}}') and try_strptime(d, '%d-%b-%Y') is not null as long_ok,
    regexp_full_match(d, '\d\d-[A-Za-z]{{3}}-\d\d') and try_strptime(substr(d, 1, 7) || case when try_cast(substr(d, 8, 2) as int) % 4 = 0 then '2000' else '2001' end, '%d-%b-%Y') is not null as short_ok from t),
j as (
  select *, case
    when line = '' then 'empty_interior_line'
    when not ok then 'csv_syntax_error'
    when fmt is null or len(v) <> w or (fmt = 'legacy13' and len(v) = 14 and v[14] <> '') then 'row_fieldcount_mismatch'
    when fmt = 'legacy13' and d = '' then 'legacy_timestamp_blank'
    when fmt = 'legacy13' and not coalesce(long_ok, false) and not coalesce(short_ok, false) then 'legacy_timestamp_unparseable'
    when fmt = 'legacy13' and not coalesce(long_ok, false) and upper(substr(d, 1, 6)) is distinct from upper(strftime(day, '%d-%b')) then 'legacy_two_digit_year_unresolvable'
    when fmt = 'udiff34' and not (regexp_full_match(d, '\d{{4}}-\d\d-\d\d') and try_strptime(d, '%Y-%m-%d') is not null) then 'udiff_traddt_unparseable'
    when len(list_filter(decs, lambda x: not regexp_full_match(x, '{_DEC}'))) > 0 or len(list_filter(ints, lambda x: not regexp_full_match(x, '{_INT}'))) > 0 then 'numeric_field_unparseable'
  end as reason_code from u)"""
_NAMES = {k: "[" + ", ".join(f"'{n}'" for n, _ in v) + "]" for k, v in LAYOUTS.items()}
_PICKS = ",\n  ".join(f"case when fmt = 'legacy13' then {f'v[{[n for n, _ in LEGACY].index(o) + 1}]' if o else 'null'} else v[{[n for n, _ in UDIFF].index(m) + 1}] end as {c}" for c, o,
    m in FIELD_MAP if c != "business_date")
_SHADOWS = ", ".join([f"try_cast({c} as decimal(38, 10)) as {c}_value" for c in ("price_open", "price_high", "price_low", "price_close", "price_last", "price_prev_close",
    "traded_value")] + [f"try_cast({c} as bigint) as {c}_value" for c in ("traded_quantity", "trades_count")])


@query(_LINES + "\nselect record_id, reason_code from j where reason_code is not null")
def p4_found(spark, sf):
    return quarantine.quarantine(table(spark, sf, "raw_records"), table(spark, sf, "members")).select("record_id", "reason_code")


@query(_LINES + rf""",
n as (select *, case when fmt = 'legacy13' then {_NAMES["legacy13"]} when fmt = 'udiff34' then {_NAMES["udiff34"]} else [] end as names,
  case when fmt = 'legacy13' then [3, 4, 5, 6, 7, 8, 9, 10, 12] else [15, 16, 17, 18, 19, 20, 25, 26, 27] end as typed from j where reason_code is not null)
select record_id, member_id, line_number, reason_code, case when reason_code not in ('empty_interior_line', 'csv_syntax_error') then cast(len(v) as int) end as physical_width,
  case when reason_code = 'csv_syntax_error' then names[len(regexp_extract_all(regexp_extract(line,
  '^(?:{_F},)*', 0), '({_F}),', 1)) + 1] when reason_code = 'row_fieldcount_mismatch' then names[len(v) + 1]
    when starts_with(reason_code, 'legacy') then 'TIMESTAMP' when starts_with(reason_code, 'udiff') then 'TradDt'
    when reason_code = 'numeric_field_unparseable' then names[list_filter(typed, lambda i: not regexp_full_match(v[i], case when names[i] in ('TOTTRDQTY', 'TOTALTRADES', 'TtlTradgVol',
  'TtlNbOfTxsExctd') then '{_INT}' else '{_DEC}' end))[1]] end as broken_field,
  raw_line from n""")
def p4_quarantine(spark, sf):
    return quarantine.quarantine(table(spark, sf, "raw_records"), table(spark, sf, "members"))


@query(_LINES + rf""",
c as (select record_id, member_id, line_number, fmt as format_family,
  {_PICKS},
  case when fmt = 'udiff34' then cast(d as date) when length(d) = 11 then cast(try_strptime(d, '%d-%b-%Y') as date) else day end as business_date,
  case when fmt = 'udiff34' then 'udiff_traddt' when length(d) = 11 then 'legacy_row_date_four_digit_year' else 'legacy_row_date_two_digit_year_cross_checked_against_source_date' end as business_date_basis
  from j where reason_code is null)
select *, {_SHADOWS} from c""")
def p4_loaded(spark, sf):
    return quarantine.loaded(table(spark, sf, "raw_records"), table(spark, sf, "members"))


def _units_sql() -> str:
    """SQL of p5_found, written from the statement: word lists of its own, whole numbers of 128 bits instead of decimals."""
    number = r"([0-9]+|[0-9]{1,3}(?:,[0-9]{2,3})+)(\.[0-9]+)?(?:e([+-]?[0-9]+))?"
    scale = r"(thousand|k|lakhs?|lacs?|l|million|mn|m|crores?|cr\.?)?"
    text = lambda c: rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
    power = lambda w: rf"case when {w} in ('thousand', 'k') then 3 when regexp_full_match({w}, 'l|lakhs?|lacs?') then 5 when {w} in ('million', 'mn', 'm') then 6 when regexp_full_match({w}, 'cr\.?|crores?') then 7 else 0 end"
    said = lambda w: rf"case when regexp_matches({w}, 'crore|[^a-z]cr[^a-z]') then 7 when regexp_matches({w}, 'lakh|lac') then 5 when regexp_matches({w}, 'thousand|''000') then 3 when regexp_matches({w}, 'million|[^a-z]mn[^a-z]') then 6 else 0 end"
    value_name, quantity_name = "turnover|values?|tottrdval", "quantity|qty|volumes?|tottrdqty"

    def read(c, x, before, after):
        part = lambda i: f"regexp_extract({text(c)}, '{before}{number}\\s*{after}', {i})"
        return (
            f"coalesce(regexp_full_match({c}, '[0-9]+(\\.[0-9]+)?'), false) as {x}_plain, {part(1)} as {x}_cur, {part(5)} as {x}_word, {part(6)} as {x}_noun, "
            f"try_cast(replace({part(2)}, ',', '') || substr({part(3)}, 2) as hugeint) as {x}_digits, greatest(length({part(3)}) - 1, 0) - coalesce(try_cast({part(4)} as int), 0) as {x}_dec"
        )

    value_text, quantity_text = ("^(rs\\.?|inr|₹)?\\s*", scale + "\\s*(/-|paise)?$"), ("^()", scale + "\\s*(nos\\.|shares|lots)?$")
    # digits * 10^up / 10^down, half away from zero.
    shift = lambda d, up, down: f"(case when {up} >= {down} then {d} * cast(power(10, {up} - {down}) as hugeint) else (2 * {d} + cast(power(10, {down} - {up}) as hugeint)) // (2 * cast(power(10, {down} - {up}) as hugeint)) end)"
    return rf"""
with n as (
  select member_id, note, regexp_matches(note, '{value_name}|{quantity_name}') as named, regexp_extract(note || ' ', '(?:{value_name})([^a-z].*?)(?:{quantity_name}|;|$)', 1) as nv, regexp_extract(note || ' ', '(?:{quantity_name})([^a-z].*?)(?:{value_name}|;|$)', 1) as nq
  from (select member_id, lower(coalesce(units_note, '')) as note from members) z),
s as (
  select member_id, regexp_matches(case when named then nv else note end, 'rupees|rs[^a-z]|inr') or (named and {said("nv")} > 0) as v_said, {said("nv")} as v_up,
    regexp_matches(case when named then nq else note end, 'shares|lots') or (named and {said("nq")} > 0) as q_said, {said("nq")} as q_up, regexp_matches(nq, 'lots') as q_lots from n),
r as (
  select row_id, member_id, try_cast(price_close as double) as px, try_cast(new_brd_lot_qty as int) as lot, {read("tottrdqty", "q", *quantity_text)}, {read("tottrdval", "v", *value_text)}
  from price_rows),
u as (select * from r left join s using (member_id)),
q as (
  select *, case when not q_plain and q_word || q_noun <> '' then {power("q_word")} when q_said then q_up else 0 end as q_pow,
    case when not q_plain and q_word || q_noun <> '' then q_noun = 'lots' else coalesce(q_lots, false) end as in_lots from u),
x as (
  select *, q_digits * case when in_lots then lot else 1 end as q_mant from q),
w as (
  select *, cast(q_mant as double) * power(10.0, q_pow - q_dec) * px as expected, cast(v_digits as double) * power(10.0, -v_dec) as val from x),
g as (
  select *, case when not v_plain and v_cur || v_word || v_noun <> '' then case when v_noun = 'paise' then -2 else {power("v_word")} end when v_said then v_up
    when val > 0 and expected > 0 then case when abs(ln(val / expected)) <= abs(ln(val * 1e3 / expected)) then 0 when abs(ln(val * 1e3 / expected)) <= abs(ln(val * 1e5 / expected)) then 3
      when abs(ln(val * 1e5 / expected)) <= abs(ln(val * 1e7 / expected)) then 5 else 7 end else 0 end as v_pow from w),
o as (
  select row_id, 'tottrdqty' as field_name, {shift("q_mant", "q_pow", "q_dec")} as common_value, not q_plain or q_pow <> 0 or in_lots as odd from g where q_mant is not null
  union all select row_id, 'tottrdval', {shift("v_digits", "(v_pow + 2)", "v_dec")}, not v_plain or v_pow <> 0 from g where v_digits is not null)
select row_id, field_name, cast(common_value as bigint) as common_value from o where odd"""


@query(_units_sql())
def p5_found(spark, sf):
    return units.converted(table(spark, sf, "price_rows"), table(spark, sf, "members"))


@query(r"""
with h as (
  select file_id, lower(regexp_replace(replace(replace(unnest(string_split(header_line, delim)), '"', ''), chr(65279), ''), '^\s+|\s+$', '', 'g')) as name,
    generate_subscripts(string_split(header_line, delim), 1) as pos from feed_files),
l as (select file_id, delim, unnest(string_split(body, chr(10))) as line from feed_files),
d as (select file_id, regexp_replace(unnest(string_split(line, delim)), '^\s+|\s+$', '', 'g') as val, generate_subscripts(string_split(line, delim), 1) as pos from l where regexp_matches(line, '\S')),
v as (select distinct file_id, pos, val from d where val <> ''),
k as (
  select file_id, pos, count(*) as n, case when bool_and(regexp_full_match(val, '-?[0-9]+')) then 'integer' when bool_and(regexp_full_match(val, '-?[0-9]+(\.[0-9]+)?')) then 'decimal'
    when bool_and(regexp_full_match(val, '[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}-(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)-[0-9]{4}')) then 'date' else 'text' end as kind from v
  group by file_id, pos),
c as (select h.file_id, name, pos, kind, coalesce(n, 0) as n from (select file_id, name, min(pos) as pos from h where name <> '' group by file_id, name) h left join k using (file_id, pos)),
p as (select file_id, lag(file_id) over (partition by feed order by file_date nulls first, file_id) as prev from feed_files),
nw as (select p.file_id, prev, c.name, c.pos, c.kind, c.n from p join c using (file_id) where prev is not null and not exists (select 1 from c o where o.file_id = prev and o.name = c.name)),
gn as (select p.file_id, prev, o.name, o.pos, o.kind from p join c o on o.file_id = prev where not exists (select 1 from c where c.file_id = p.file_id and c.name = o.name)),
f as (select lower(field_name) as name, min(canonical_field) as canon from field_names group by 1),
sh as (
  select g.file_id, g.pos as gpos, w.pos as npos, count(*) as shared from gn g join nw w using (file_id) join v a on a.file_id = g.prev and a.pos = g.pos
  join v b on b.file_id = w.file_id and b.pos = w.pos and b.val = a.val group by all),
pr as (
  select g.file_id, g.name as old_name, w.name as new_name, g.kind as k0, w.kind as k1, g.pos as gpos, w.pos as npos,
    case when fg.canon is not null and fn.canon is not null then case when fg.canon = fn.canon then 2.0 else 0.0 end else coalesce(shared, 0) / greatest(w.n, 1) end as score
  from gn g join nw w using (file_id) left join f fg on fg.name = g.name left join f fn on fn.name = w.name left join sh on sh.file_id = g.file_id and sh.gpos = g.pos and sh.npos = w.pos),
rn as (
  select * from (select *, row_number() over (partition by file_id, old_name order by score desc, npos) as a, row_number() over (partition by file_id, new_name order by score desc, gpos) as b
  from pr where score >= 0.5) z where a = 1 and b = 1)
select file_id, 'renamed' as change_kind, old_name, new_name from rn
union all select file_id, 'retyped', old_name, new_name from rn where k0 <> k1
union all select file_id, 'added', '', name from nw where not exists (select 1 from rn where rn.file_id = nw.file_id and new_name = name)
union all select file_id, 'removed', name, '' from gn where not exists (select 1 from rn where rn.file_id = gn.file_id and old_name = name)
union all select p.file_id, 'retyped', c.name, c.name from p join c using (file_id) join c o on o.file_id = prev and o.name = c.name where c.kind <> o.kind""")
def p6_found(spark, sf):
    return drift.change_log(table(spark, sf, "feed_files"), table(spark, sf, "field_names")).select("file_id", "change_kind", "old_name", "new_name")


@query()
def p6_schema(spark, sf):
    return drift.union_schema(table(spark, sf, "feed_files"), table(spark, sf, "field_names"))


@query()
def p6_table(spark, sf):
    """Every body line of every file in one table, cast to the union schema; what is in no dictionary as JSON text."""
    rows = drift.typed_table(table(spark, sf, "feed_files"), table(spark, sf, "field_names"))
    return rows.withColumn("other", F.to_json("other"))


_BLANK_COLUMNS = ("symbol", "series", "isin", "price_open", "price_high", "price_low", "price_last", "price_prev_close", "totaltrades")
_ISIN_OK = """case when regexp_full_match(i, 'IN[A-Z0-9]{9}[0-9]') then
  list_sum(list_transform(list_reverse(string_split(list_aggregate(list_transform(string_split(i, ''),
    lambda c: case when c between 'A' and 'Z' then cast(ord(c) - 55 as varchar) else c end), 'string_agg', ''), '')),
    lambda c, k: case when k % 2 = 1 then cast(c as int) when cast(c as int) > 4 then cast(c as int) * 2 - 9 else cast(c as int) * 2 end)) % 10 = 0 else false end"""
_BLANKS = ", ".join(f"cast({_BLANK.format(c)} as int) as b_{c}" for c in _BLANK_COLUMNS)
_JUMPS = " union all ".join(
    [f"select member_id, '{c}' as field_name, 'blank_jump' as finding, b_{c} as x, n, lag(b_{c}) over w as x0, lag(n) over w as n0 from pm window w as (partition by feed order by date_from_filename)" for c in _BLANK_COLUMNS]
    + ["select member_id, 'isin', 'pattern_jump', bad, n, lag(bad) over w, lag(n) over w from pm window w as (partition by feed order by date_from_filename)"]
)


@query(rf"""
with once as (
  select * from price_rows qualify row_number() over (partition by member_id, source_line_number order by loaded_at desc, row_id desc) = 1),
c as (select *, {_N.format("isin")} as i, {_BLANKS} from once),
v as (select *, cast(b_isin = 0 and not {_ISIN_OK} as int) as bad from c),
m as (select member_id, count(*) as n, sum(bad) as bad, {", ".join(f"sum(b_{c}) as b_{c}" for c in _BLANK_COLUMNS)} from v group by member_id),
pm as (select members.feed, members.date_from_filename, m.* from members join m using (member_id)),
j as ({_JUMPS}),
g as (
  select group_id, max(blank_or_ws_isin_rows) as said, coalesce(sum(b_isin), 0) as cnt
  from ud_census_groups u left join (select v.*, members.feed, members.date_from_filename from v join members using (member_id) where format_family = 'udiff34') x
    on x.feed = u.feed and x.date_from_filename between u.period_from and u.period_to and x.sgmt is not distinct from u.sgmt and x.src is not distinct from u.src
    and x.fininstrmtp is not distinct from u.fininstrmtp and {_N.format("x.series")} is not distinct from {_N.format("u.sctysrs")}
  group by group_id),
f as (select metric_id, blank_isin_rows, invalid_isin_rows, coalesce(b_isin, 0) as b, coalesce(bad, 0) as bad from file_metrics left join m using (member_id))
select 'file_metrics' as table_name, metric_id as row_key, 'blank_isin_rows' as field_name, 'wrong_count' as finding from f where blank_isin_rows is distinct from b
union all select 'file_metrics', metric_id, 'invalid_isin_rows', 'wrong_count' from f where invalid_isin_rows is distinct from bad
union all select 'ud_census_groups', group_id, 'blank_or_ws_isin_rows', 'wrong_count' from g where said is distinct from cnt
union all select 'members', member_id, field_name, finding from j where (x * n0 - x0 * n) * 100 > 15 * n * n0""")
def p7_found(spark, sf):
    return profile.findings(table(spark, sf, "price_rows"), table(spark, sf, "members"), table(spark, sf, "file_metrics"), table(spark, sf, "ud_census_groups"))


_CELLS = """
with once as (select * from price_rows qualify row_number() over (partition by member_id, source_line_number order by loaded_at desc, row_id desc) = 1),
t as (select member_id as member, columns(*)::varchar from once),
u as (select * from t unpivot include nulls (text for field_name in (columns(* exclude (member))))),
x as (select member, field_name, text, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as s, field_name = 'loaded_at' as is_time from u),
y as (select *, text is null or s = '' as blank, case when regexp_full_match(s, '-?[0-9]+(\\.[0-9]+)?') then try_cast(s as decimal(38, 10)) end as number,
  case when is_time then cast(try_cast(text as timestamp) as date) when regexp_full_match(s, '[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast(s as date)
    when regexp_full_match(s, '[0-9]{2}-[A-Za-z]{3}-[0-9]{4}') then cast(try_strptime(s, '%d-%b-%Y') as date) end as day, upper(s) as i from x)
"""


@query(_CELLS + f"""
select member as member_id, field_name, count(*) as rows, count(*) filter (blank) as blanks, count(distinct case when not blank then text end) as distinct_estimate,
  count(number) as numbers, count(day) as dates, count(*) filter ({_ISIN_OK}) as codes, min(number) as least_number, max(number) as greatest_number, min(day) as least_date, max(day) as greatest_date,
  min(case when not blank and number is null and day is null then text end) as least_text, max(case when not blank and number is null and day is null then text end) as greatest_text
from y group by member, field_name""")
def p7_profile(spark, sf):
    """The profile without its sketches. Up to a few hundred distinct values of a column and member a sketch counts them one by one."""
    return profile.column_profile(table(spark, sf, "price_rows")).drop("distinct_sketch")


@query(rf"""
with once as (
  select * from price_rows qualify row_number() over (partition by member_id, source_line_number order by loaded_at desc, row_id desc) = 1),
c as (select *, {_N.format("isin")} as i, {_BLANKS} from once),
m as (select member_id, count(*) as n, sum(cast(b_isin = 0 and not {_ISIN_OK} as int)) as bad, {", ".join(f"sum(b_{c}) as b_{c}" for c in _BLANK_COLUMNS)} from c group by member_id),
s as (
  select feed, date_from_filename as d, member_id, unnest(['invalid_isin',
  {", ".join(f"'blank_{c}'" for c in _BLANK_COLUMNS)}]) as metric, unnest([bad / n, {", ".join(f"b_{c} / n" for c in _BLANK_COLUMNS)}]) as share
  from m join members using (member_id) where d is not null),
h as (
  select *, avg(share) over w as mean, stddev_pop(share) over w as sd, count(share) over w as seen from s
  window w as (partition by feed, metric order by d, member_id rows between unbounded preceding and 1 preceding))
select feed, member_id, metric, round(share, 9) as share, round(mean, 9) as mean, round(mean + 3 * greatest(sd, 0.001), 9) as "limit" from h where seen >= 8 and share > mean + 3 * greatest(sd, 0.001)""")
def p7_control_limits(spark, sf):
    state = materialize(profile.states(profile.row_masks(table(spark, sf, "price_rows"))))
    found = profile.control_limits(state, table(spark, sf, "members"))
    return found.withColumns({c: F.round(c, 9) for c in ("share", "mean", "limit")})
