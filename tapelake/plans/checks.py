"""What must hold of the tables: reconciliation in four tiers, preflight, data quality in sections, and the full calendar.

A reconciliation record holds what was published against what is there, for one file (scope
`member`) or one root or feed: tier, check_name, scope, scope_key, expected, observed, delta
(observed - expected of whole numbers), result (match, divergence, or not-comparable where a side
is unknown) and gating. Tier A is about the archives, G about the agreement of documents, C about
contents, E is evidence that never gates. Lines delivered twice count once, the latest of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.isin import luhn_is_valid
from ..functions.text import is_blank, norm
from ..operators import calendar as cal
from ..operators import profile, quarantine
from ..schema import OVERLAY_SERIES
from ..session import fixed, materialize, table
from .views import ROWS, once, rows

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- facts of members


def member_facts(lines: DataFrame) -> DataFrame:
    """member_id, lines, blank, valid, invalid, valid_codes, symbols, least_family, greatest_family, other_days: what the rows of each member say."""
    keep = ["row_id", "member_id", "source_line_number", "loaded_at", "isin", "symbol", "format_family", "raw_biz_dt", "trade_date"]
    df = profile.latest(lines.select(*keep)).withColumn("code", F.coalesce(norm(F.col("isin")), F.lit("")))
    shape = F.col("code").rlike(r"^IN[A-Z0-9]{9}[0-9]\z")
    df = fixed(df, good=F.when(shape, luhn_is_valid(F.col("code"))).otherwise(False))
    day = F.when(F.col("format_family") == "legacy13", F.upper(F.date_format("trade_date", "dd-MMM-yyyy"))).otherwise(F.col("trade_date").cast("string"))
    other = ~is_blank(F.col("raw_biz_dt")) & (F.upper("raw_biz_dt") != day)
    return df.groupBy("member_id").agg(
        F.count("*").alias("lines"), F.count_if(F.col("code") == "").alias("blank"), F.count_if("good").alias("valid"), F.count_if((F.col("code") != "") & ~F.col("good")).alias("invalid"),
        F.countDistinct(F.when(F.col("good"), F.col("code"))).alias("valid_codes"), F.countDistinct(F.when(~is_blank(F.col("symbol")), norm(F.col("symbol")))).alias("symbols"),
        F.min("format_family").alias("least_family"), F.max("format_family").alias("greatest_family"), F.count_if(F.coalesce(other, F.lit(False))).alias("other_days"),
    )


def _facts(spark, sf, facts: DataFrame | None) -> DataFrame:
    return member_facts(rows(spark, sf)) if facts is None else facts


_FACTS = rf"""with {ROWS},
ln as (select * from rows qualify row_number() over (partition by member_id, source_line_number order by loaded_at desc, row_id desc) = 1),
fa as (
  select member_id, count(*) as lines, count(*) filter (validity = 'BLANK') as blank, count(*) filter (validity = 'VALID') as valid, count(*) filter (validity not in ('BLANK', 'VALID')) as invalid,
    count(distinct case when validity = 'VALID' then isin_n end) as valid_codes, count(distinct case when regexp_matches(symbol, '\S') then upper(regexp_replace(symbol, '^\s+|\s+$', '',
  'g')) end) as symbols,
    min(format_family) as least_family, max(format_family) as greatest_family,
    count(*) filter (regexp_matches(raw_biz_dt, '\S') and upper(raw_biz_dt) <> case when format_family = 'legacy13' then upper(strftime(trade_date, '%d-%b-%Y')) else strftime(trade_date,
  '%Y-%m-%d') end) as other_days
  from ln group by member_id),
pu as (select * from file_metrics qualify row_number() over (partition by member_id order by published_at desc nulls last, metric_id desc) = 1)"""


def published(metrics: DataFrame) -> DataFrame:
    """The latest published figures of each member."""
    figures = ["row_count", "blank_isin_rows", "valid_isin_rows", "invalid_isin_rows", "distinct_valid_isin", "distinct_symbols"]
    latest = metrics.groupBy("member_id").agg(F.max(F.struct("published_at", "metric_id", *figures)).alias("x"))
    return latest.select("member_id", *[F.col(f"x.{c}").alias(f"said_{c}") for c in figures])


# ---- reconciliation


def _record(name: str, expected: Column, observed: Column) -> Column:
    return F.struct(F.lit(name).alias("check_name"), expected.cast("string").alias("expected"), observed.cast("string").alias("observed"))


def _records(df: DataFrame, tier: str, scope: str, key: str, checks: list[Column], gating: bool) -> DataFrame:
    """One row a check and row of `df`."""
    out = df.select(F.col(key).cast("string").alias("scope_key"), F.explode(F.array(*checks)).alias("c")).select("scope_key", "c.*")
    delta = F.col("observed").try_cast("bigint") - F.col("expected").try_cast("bigint")
    result = F.when(F.col("expected").isNull() | F.col("observed").isNull(), "not-comparable").when(F.col("expected") == F.col("observed"), "match").otherwise("divergence")
    return out.select(F.lit(tier).alias("tier"), "check_name", F.lit(scope).alias("scope"), "scope_key", "expected", "observed", delta.alias("delta"), result.alias("result"),
        F.lit(gating).alias("gating"))


_RECORD = """{facts},
rc as ({union})
select '{tier}' as tier, check_name, scope, scope_key, expected, observed, try_cast(observed as bigint) - try_cast(expected as bigint) as delta,
  case when expected is null or observed is null then 'not-comparable' when expected = observed then 'match' else 'divergence' end as result, {gating} as gating from rc"""


def _sql(tier: str, gating: bool, parts: list[tuple[str, str, str, str, str, str]]) -> str:
    """parts: (check_name, scope, key, expected, observed, source)."""
    union = "\n  union all ".join(f"select '{n}' as check_name, '{s}' as scope, cast({k} as varchar) as scope_key, cast({e} as varchar) as expected, cast({o} as varchar) as observed from {src}" for n, s, k, e, o, src in parts)
    return _RECORD.format(facts=_FACTS, union=union, tier=tier, gating=str(gating).lower())


_DATE_IN_NAME = r"""case when root = 'LEGACY' then strftime(try_strptime(regexp_extract(file_name, 'cm(\d\d[A-Z]{3}\d{4})', 1), '%d%b%Y'), '%Y-%m-%d')
  else strftime(try_strptime(regexp_extract(file_name, '_(\d{8})_', 1), '%Y%m%d'), '%Y-%m-%d') end"""


@query(_sql("A", True, [
    ("archive_sha256", "member", "member_id", "'64 hex digits'", "case when regexp_full_match(sha256, '[0-9a-f]{64}') then '64 hex digits' else sha256 end", "members"),
    ("family", "member", "member_id", "case root when 'LEGACY' then 'legacy13' when 'UDIFF' then 'udiff34' end", "detected_format", "members"),
    ("header_shape", "member", "member_id", "case root when 'LEGACY' then '13 or 14' when 'UDIFF' then '34' end",
        "case when header_width in (13, 14) then '13 or 14' else cast(header_width as varchar) end", "members"),
    ("member_identity", "member", "member_id", "file_name", "regexp_extract(relative_path, '([^/]*)$', 1)", "members"),
    ("expected_source_date", "member", "member_id", _DATE_IN_NAME, "date_from_filename", "members"),
    ("archive_basis", "member", "members.member_id", "detected_format", "case when least_family = greatest_family then least_family when least_family is not null then 'mixed' end",
        "members left join fa using (member_id)"),
]))
def reconciliation_archives(spark, sf, facts=None):
    """Tier A: digest, family, header, name, day and rows of every archive."""
    m = table(spark, sf, "members").join(_facts(spark, sf, facts).select("member_id", "least_family", "greatest_family"), "member_id", "left")
    legacy, modern = F.col("root") == "LEGACY", F.col("root") == "UDIFF"
    name = F.col("file_name")
    named_day = F.when(legacy, F.try_to_date(F.initcap(F.regexp_extract(name, r"cm(\d\d[A-Z]{3}\d{4})", 1)), "ddMMMyyyy")).otherwise(F.try_to_date(F.regexp_extract(name, r"_(\d{8})_", 1), "yyyyMMdd"))
    basis = F.when(F.col("least_family") == F.col("greatest_family"), F.col("least_family")).when(F.col("least_family").isNotNull(), "mixed")
    width = F.col("header_width")
    return _records(m, "A", "member", "member_id", [
        _record("archive_sha256", F.lit("64 hex digits"), F.when(F.col("sha256").rlike(r"^[0-9a-f]{64}\z"), "64 hex digits").otherwise(F.col("sha256"))),
        _record("family", F.when(legacy, "legacy13").when(modern, "udiff34"), F.col("detected_format")),
        _record("header_shape", F.when(legacy, "13 or 14").when(modern, "34"), F.when(width.isin(13, 14), "13 or 14").otherwise(width.cast("string"))),
        _record("member_identity", name, F.regexp_extract("relative_path", r"([^/]*)\z", 1)),
        _record("expected_source_date", named_day, F.col("date_from_filename")),
        _record("archive_basis", F.col("detected_format"), basis),
    ], True)


_SHA = "members m join (select sha256, count(*) as n from members group by sha256) s on s.sha256 is not distinct from m.sha256"
_WIDTHS = "members m left join (select member_id, count(*) as n, count(*) filter (len(string_split(raw_line, ',')) = header_width) as k from raw_records join members using (member_id) where raw_line not like '%\"%' group by member_id) w using (member_id)"


@query(_sql("G", True, [
    ("member_digest", "member", "member_id", "1", "n", _SHA),
    ("member_size", "member", "member_id", "'positive'", "case when size_bytes > 0 then 'positive' else cast(size_bytes as varchar) end", "members"),
    ("header_list", "member", "m.member_id", "case when w.n > 0 then 'most lines' end", "case when w.k * 2 > w.n then 'most lines' else 'few lines' end", _WIDTHS),
    ("verdict_vs_fold", "root", "root", "case when bool_and(coalesce(valid_isin_rows + blank_isin_rows + invalid_isin_rows = row_count, true)) then 'consistent' else 'inconsistent' end",
        "'consistent'", "file_metrics where root is not null group by root"),
]))
def reconciliation_documents(spark, sf, facts=None):
    """Tier G: one archive a digest, known sizes, lines as wide as their header, published figures that add up."""
    m = table(spark, sf, "members").select("member_id", "sha256", "size_bytes", "header_width")
    copies = m.groupBy(F.col("sha256").alias("_s")).agg(F.count("*").alias("copies"))
    # Lines without quotes have as many fields as commas and one; the others are left to the parser.
    raw = table(spark, sf, "raw_records").where(~F.col("raw_line").contains('"')).join(m.select("member_id", "header_width"), "member_id")
    wide = raw.groupBy("member_id").agg(F.count("*").alias("n"), F.count_if(F.length("raw_line") - F.length(F.translate("raw_line", ",", "")) + 1 == F.col("header_width")).alias("k"))
    per = m.join(copies, F.col("sha256").eqNullSafe(F.col("_s"))).join(wide, "member_id", "left")
    members = _records(per, "G", "member", "member_id", [
        _record("member_digest", F.lit(1), F.col("copies")),
        _record("member_size", F.lit("positive"), F.when(F.col("size_bytes") > 0, "positive").otherwise(F.col("size_bytes").cast("string"))),
        _record("header_list", F.when(F.col("n") > 0, "most lines"), F.when(F.col("k") * 2 > F.col("n"), "most lines").otherwise("few lines")),
    ], True)
    adds_up = F.col("valid_isin_rows") + F.col("blank_isin_rows") + F.col("invalid_isin_rows") == F.col("row_count")
    roots = table(spark, sf, "file_metrics").where("root is not null").groupBy("root").agg(F.every(F.coalesce(adds_up, F.lit(True))).alias("ok"))
    verdict = F.when(F.col("ok"), "consistent").otherwise("inconsistent")
    return members.unionByName(_records(roots, "G", "root", "root", [_record("verdict_vs_fold", verdict, F.lit("consistent"))], True))


_PAIRS = (
    ("rows", "row_count", "lines"), ("blank_isin", "blank_isin_rows", "blank"), ("valid_isin", "valid_isin_rows", "valid"), ("invalid_isin", "invalid_isin_rows", "invalid"),
    ("distinct_valid_isin", "distinct_valid_isin", "valid_codes"), ("distinct_symbols", "distinct_symbols", "symbols"),
)
_JOINED = "members m left join fa using (member_id) left join pu using (member_id)"
_FOLDED = "(select m.root, count(*) as n, count(pu.metric_id) as with_metrics, " + ", ".join(f"sum(pu.{s}) as s_{s}, sum(case when pu.{s} is not null then coalesce(fa.{o}, 0) end) as o_{s}" for _, s, o in _PAIRS[:5]) + f" from {_JOINED} group by m.root) z"


@query(_sql("C", True, [
    *[(n, "member", "m.member_id", f"pu.{s}", f"coalesce(fa.{o}, 0)", _JOINED) for n, s, o in _PAIRS],
    ("dates", "member", "m.member_id", "case when fa.lines is not null then 0 end", "fa.other_days", _JOINED),
    *[(f"fold_{n}", "root", "root", f"cast(s_{s} as bigint)", f"cast(o_{s} as bigint)", _FOLDED) for n, s, _ in _PAIRS[:5]],
    ("fold_members", "root", "root", "n", "with_metrics", _FOLDED),
]))
def reconciliation_contents(spark, sf, facts=None):
    """Tier C: published figures of every file and root against its rows."""
    j = table(spark, sf, "members").select("member_id", "root").join(_facts(spark, sf, facts), "member_id", "left").join(published(table(spark, sf, "file_metrics")).withColumn("has",
        F.lit(True)), "member_id", "left")
    j = materialize(j)  # a row a member, read twice
    counted = lambda o: F.coalesce(F.col(o), F.lit(0))
    per = [_record(n, F.col(f"said_{s}"), counted(o)) for n, s, o in _PAIRS] + [_record("dates", F.when(F.col("lines").isNotNull(), 0), F.col("other_days"))]
    sums = [f for _, s, o in _PAIRS[:5] for f in (F.sum(f"said_{s}").alias(f"s_{s}"), F.sum(F.when(F.col(f"said_{s}").isNotNull(), counted(o))).alias(f"o_{s}"))]
    roots = j.groupBy("root").agg(F.count("*").alias("n"), F.count("has").alias("with_metrics"), *sums)
    fold = [_record(f"fold_{n}", F.col(f"s_{s}"), F.col(f"o_{s}")) for n, s, _ in _PAIRS[:5]] + [_record("fold_members", F.col("n"), F.col("with_metrics"))]
    return _records(j, "C", "member", "member_id", per, True).unionByName(_records(roots, "C", "root", "root", fold, True))


_CENSUS_ROWS = """(select c.feed, c.said, count(ln.row_id) as counted from (select feed, sum(row_count) as said, min(period_from) as a, max(period_to) as b from ud_census_groups
  where feed is not null group by feed) c
  left join ln on ln.feed = c.feed and ln.format_family = 'udiff34' and ln.trade_date between c.a and c.b group by c.feed, c.said) z"""


@query(_sql("E", False, [
    ("size_corroboration", "member", "m.member_id", "case when m.row_count is not null then '20 bytes a row or more' end",
        "case when m.size_bytes >= 20 * m.row_count then '20 bytes a row or more' else cast(m.size_bytes as varchar) end", "members m"),
    ("inventory_rows", "member", "m.member_id", "m.row_count", "coalesce(fa.lines, 0)", "members m left join fa using (member_id)"),
    ("census_rows", "feed", "feed", "cast(said as bigint)", "counted", _CENSUS_ROWS),
]))
def reconciliation_evidence(spark, sf, facts=None):
    """Tier E, which never gates: sizes, row counts of the inventory, and the published census against the rows of its feed."""
    r = rows(spark, sf)
    m = table(spark, sf, "members").select("member_id", "row_count", "size_bytes").join(_facts(spark, sf, facts).select("member_id", "lines"), "member_id", "left")
    enough = "20 bytes a row or more"
    per = _records(m, "E", "member", "member_id", [
        _record("size_corroboration", F.when(F.col("row_count").isNotNull(), enough), F.when(F.col("size_bytes") >= 20 * F.col("row_count"), enough).otherwise(F.col("size_bytes").cast("string"))),
        _record("inventory_rows", F.col("row_count"), F.coalesce("lines", F.lit(0))),
    ], False)
    census = table(spark, sf, "ud_census_groups").where("feed is not null").groupBy("feed").agg(F.sum("row_count").alias("said"), F.min("period_from").alias("_a"), F.max("period_to").alias("_b"))
    # Lines by feed and day first: the census meets one row a file.
    keep = ["row_id", "member_id", "source_line_number", "loaded_at", "feed", "trade_date", "format_family"]
    days = profile.latest(r.select(*keep)).where("format_family = 'udiff34'").groupBy(F.col("feed").alias("_f"), "trade_date").agg(F.count("*").alias("n"))
    on = (F.col("feed") == F.col("_f")) & F.col("trade_date").between(F.col("_a"), F.col("_b"))
    feeds = census.join(days, on, "left").groupBy("feed", "said").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("counted"))
    return per.unionByName(_records(feeds, "E", "feed", "feed", [_record("census_rows", F.col("said"), F.col("counted"))], False))


_TIERS = {"A": "reconciliation_archives", "G": "reconciliation_documents", "C": "reconciliation_contents", "E": "reconciliation_evidence"}


def _every(spark, sf) -> DataFrame:
    facts = materialize(member_facts(rows(spark, sf)))  # a row a member, read by three tiers
    first, *rest = [QUERIES[n](spark, sf, facts) for n in _TIERS.values()]
    for df in rest:
        first = first.unionByName(df)
    return first


_EVERY = " union all ".join(f"select * from ({SQL[n]}) {t.lower()}x" for t, n in _TIERS.items())


@query(f"select tier, check_name, result, gating, count(*) as records from ({_EVERY}) z group by all")
def reconciliation_summary(spark, sf):
    """Records of all 26 checks by tier and result."""
    return _every(spark, sf).groupBy("tier", "check_name", "result", "gating").agg(F.count("*").alias("records"))


@query(f"select check_name, count(*) as failures, min(scope_key) as first_scope from ({_EVERY}) z where gating and result = 'divergence' group by check_name")
def gating_failures(spark, sf):
    """Checks that stop a run, with how often and where first."""
    return _every(spark, sf).where("gating and result = 'divergence'").groupBy("check_name").agg(F.count("*").alias("failures"), F.min("scope_key").alias("first_scope"))


# ---- preflight

_PF = (
    ("PF-00 no gating divergence of digests", "select count(*) = 0 from members where not coalesce(regexp_full_match(sha256, '[0-9a-f]{64}'), false)"),
    ("PF-01 formats known", "select count(*) = 0 from members where detected_format is null or detected_format not in ('legacy13', 'udiff34')"),
    ("PF-02 widths known", "select count(*) = 0 from members where not coalesce(case when detected_format = 'legacy13' then header_width in (13, 14) else header_width = 34 end, false)"),
    ("PF-03 rows have members", "select count(*) = 0 from price_rows p where not exists (select 1 from members m where m.member_id = p.member_id)"),
    ("PF-04 paths lie under their root", "select count(*) = 0 from members where not coalesce(starts_with(relative_path, lower(root) || '/'), false)"),
    ("PF-05 inventory complete", "select count(*) = 0 from members where file_name is null or relative_path is null or date_from_filename is null or detected_format is null or sha256 is null"),
    ("PF-06 distinct names", "select count(*) = count(distinct file_name) from members"),
    ("PF-07 sizes known", "select count(*) filter (size_bytes is null or size_bytes < 0) = 0 from members"),
    ("PF-08 figures published", "select count(*) = 0 from members m where not exists (select 1 from file_metrics f where f.member_id = m.member_id)"),
    ("PF-09 no empty file", "select count(*) = 0 from members where row_count <= 0"),
    ("PF-10 metrics have members", "select count(*) filter (m.member_id is null) = 0 from file_metrics f left join members m using (member_id)"),
    ("PF-11 no repeated digest or day", "select count(*) = count(distinct sha256) and count(*) = count(distinct (feed, date_from_filename)) from members"),
    ("PF-12 days within the span of arrival", "select count(*) = 0 from members where date_from_filename > cast(arrived_at as date)"),
    ("PF-13 total size known", "select coalesce(sum(size_bytes), 0) > 0 from members"),
)


@query(" union all ".join(f"select '{n}' as check_name, ({s}) as passed" for n, s in _PF))
def preflight(spark, sf):
    """Fourteen checks before a run: one scan of the members, and anti joins with the tables that point to them."""
    m, x = table(spark, sf, "members"), table(spark, sf, "file_metrics").select("member_id")
    legacy = F.col("detected_format") == "legacy13"
    none = lambda bad: F.count_if(F.coalesce(bad, F.lit(False))) == 0
    fails = lambda ok: ~F.coalesce(ok, F.lit(False))
    checks = {
        0: none(fails(F.col("sha256").rlike(r"^[0-9a-f]{64}\z"))), 1: none(fails(F.col("detected_format").isin("legacy13", "udiff34"))),
        2: none(fails(F.when(legacy, F.col("header_width").isin(13, 14)).otherwise(F.col("header_width") == 34))), 4: none(fails(F.col("relative_path").startswith(F.concat(F.lower("root"),
            F.lit("/"))))),
        5: none(F.col("file_name").isNull() | F.col("relative_path").isNull() | F.col("date_from_filename").isNull() | F.col("detected_format").isNull() | F.col("sha256").isNull()),
        6: F.count("*") == F.countDistinct("file_name"), 7: none(F.col("size_bytes").isNull() | (F.col("size_bytes") < 0)), 9: none(F.col("row_count") <= 0),
        11: (F.count("*") == F.countDistinct("sha256")) & (F.count("*") == F.countDistinct(F.struct("feed", "date_from_filename"))),
        12: none(F.col("date_from_filename") > F.col("arrived_at").cast("date")), 13: F.coalesce(F.sum("size_bytes"), F.lit(0)) > 0,
    }
    one = m.agg(*[c.alias(f"c{i}") for i, c in checks.items()])
    own = one.select(F.explode(F.array(*[F.struct(F.lit(_PF[i][0]).alias("check_name"), F.col(f"c{i}").alias("passed")) for i in checks])).alias("c")).select("c.*")
    ids = m.select("member_id")
    pointing = {3: table(spark, sf, "price_rows").select("member_id").distinct().join(ids, "member_id", "left_anti"), 8: ids.join(x, "member_id", "left_anti"), 10: x.join(ids, "member_id",
        "left_anti")}
    for i, df in pointing.items():
        own = own.unionByName(df.agg((F.count("*") == 0).alias("passed")).select(F.lit(_PF[i][0]).alias("check_name"), "passed"))
    return own


# ---- data quality

# Open questions that a series or a family brings with it, and their identifiers.
GOVERNANCE = (("T0", "D07-OPEN-1"), ("IT", "D07-OPEN-2"), ("SF", "D07-OPEN-3"), ("BE", "D07-OPEN-4"))
GOVERNANCE_MODERN = "D07-OPEN-7"


def governance(series: Column, family: Column) -> Column:
    """Sorted identifiers of the open questions of a row."""
    return F.array_sort(F.array_compact(F.array(*[F.when(series == s, F.lit(k)) for s, k in GOVERNANCE], F.when(family == "udiff34", F.lit(GOVERNANCE_MODERN)))))


_OV = "('" + "', '".join(OVERLAY_SERIES) + "')"
_SECTIONS = rf"""with {ROWS},
fl as (select case validity when 'LEN' then 'isin_invalid_length' else 'isin_invalid_checkdigit' end as k from rows where validity in ('LEN', 'CHECKDIGIT')
  union all select 'bizdt_ne_traddt' from rows where format_family = 'udiff34' and regexp_matches(raw_biz_dt, '\S') and raw_biz_dt <> strftime(trade_date, '%Y-%m-%d')),
gv as (select 'D07-OPEN-1' as k from rows where series = 'T0' union all select 'D07-OPEN-2' from rows where series = 'IT' union all select 'D07-OPEN-3' from rows where series = 'SF'
  union all select 'D07-OPEN-4' from rows where series = 'BE' union all select 'D07-OPEN-7' from rows where format_family = 'udiff34'),
rt as (select case when series in {_OV} then 'overlay-excluded' when series is null or not regexp_matches(series, '\S') then 'missing-series' when identity is null then 'missing-identity'
  when ticker is null then 'missing-ticker' else 'eligible' end as k from rows)
select 'flag_census' as section, k as key, count(*) as n from fl group by k
union all select 'governance_census', k, count(*) from gv group by k
union all select 'unresolved', k, count(*) from rt where k <> 'eligible' group by k"""


def _quality_sql() -> str:
    from .problems import SQL as PROBLEMS

    return (
        f"select * from ({_SECTIONS}) s union all select 'quarantine', reason_code, count(*) from ({PROBLEMS['p4_found']}) q group by reason_code "
        f"union all select 'quarantine_published', coalesce(reason_code, 'none'), count(*) from raw_records group by 2 "
        f"union all select 'reconciliation_by_result', result, count(*) from ({_EVERY}) x group by result union all select 'reconciliation_by_tier', tier, count(*) from ({_EVERY}) y group by tier"
    )


@query(_quality_sql())
def q8_data_quality(spark, sf):
    """Data quality in sections: flags, open questions, rows without continuity, quarantined lines beside what an older reader said, and reconciliation by result and tier."""
    r = once(rows(spark, sf), "validity")
    valid = F.col("validity")
    flags = F.array_compact(F.array(
        F.when(valid == "LEN", F.lit("isin_invalid_length")), F.when(valid == "CHECKDIGIT", F.lit("isin_invalid_checkdigit")),
        F.when((F.col("format_family") == "udiff34") & F.col("raw_biz_dt").rlike(r"\S") & (F.col("raw_biz_dt") != F.col("trade_date").cast("string")), F.lit("bizdt_ne_traddt")),
    ))
    route = (
        F.when(F.col("series").isin(*OVERLAY_SERIES), "overlay-excluded").when(is_blank(F.col("series")), "missing-series").when(F.col("identity").isNull(), "missing-identity")
        .when(F.col("ticker").isNull(), "missing-ticker")
    )
    entry = lambda section: lambda k: F.struct(F.lit(section).alias("section"), k.alias("key"))
    found = F.concat(
        F.transform(flags, entry("flag_census")), F.transform(governance(F.col("series"), F.col("format_family")), entry("governance_census")),
        F.transform(F.array_compact(F.array(route)), entry("unresolved")),
    )
    # One scan of the rows counts the three sections of rows.
    sections = r.select(F.explode(found).alias("x")).groupBy("x.section", "x.key").agg(F.count("*").alias("n"))
    raw = table(spark, sf, "raw_records")
    count = lambda df, section, key: df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(section).alias("section"), "key", "n")
    judged = quarantine.judge(raw.select("record_id", "member_id", "raw_line"), table(spark, sf, "members")).where("reason is not null")
    records = materialize(_every(spark, sf).groupBy("tier", "result").agg(F.count("*").alias("n")))
    by = lambda section, key: records.groupBy(F.col(key).alias("key")).agg(F.sum("n").alias("n")).select(F.lit(section).alias("section"), "key", "n")
    return (
        sections.unionByName(count(judged, "quarantine", F.col("reason"))).unionByName(count(raw, "quarantine_published", F.coalesce("reason_code", F.lit("none"))))
        .unionByName(by("reconciliation_by_result", "result")).unionByName(by("reconciliation_by_tier", "tier"))
    )


# ---- calendar

# Month, day and name of the fixed national holidays.
HOLIDAYS = ((1, 26, "Republic Day"), (8, 15, "Independence Day"), (10, 2, "Gandhi Jayanti"))

_CALENDAR = f"""with {ROWS},
f as (select date_from_filename as d, detected_format as family, file_name, member_id from members where date_from_filename is not null),
b as (select min(d) as a, max(d) as z, max(case when family = 'legacy13' then d end) as last_legacy from f),
sp as (select cast(unnest(generate_series(cast(a as timestamp), cast(z as timestamp), interval 1 day)) as date) as trade_date, last_legacy from b),
p as (select d as trade_date, string_agg(distinct family, ',' order by family) as formats, count(*) as members, string_agg(file_name, ',' order by file_name) as member_names from f group by d),
h as (select trade_date, case strftime(trade_date, '%m-%d') when '01-26' then 'Republic Day' when '08-15' then 'Independence Day' when '10-02' then 'Gandhi Jayanti' end as holiday from sp),
rw as (select trade_date, count(*) as row_count, bool_and(regexp_matches(raw_biz_dt, '\\S')) filter (format_family = 'udiff34') as compared,
  bool_and(raw_biz_dt = strftime(trade_date, '%Y-%m-%d')) filter (format_family = 'udiff34') as equal from rows group by trade_date),
mx as (select d as trade_date, count(distinct x.member_id) as with_metrics from f join file_metrics x using (member_id) group by d)
select sp.trade_date, strftime(sp.trade_date, '%A') as weekday, members is not null as file_present, formats, member_names, coalesce(members, 0) as members,
  members is null and isodow(sp.trade_date) < 6 as missing_weekday, holiday,
  case when holiday is not null then 'official-holiday' when members is not null then 'not-applicable' when isodow(sp.trade_date) > 5 then 'weekend'
  when last_legacy is null or sp.trade_date <= last_legacy then 'not-retrieved' else 'unexplained' end as label,
  holiday is not null and members is not null as holiday_with_file, row_count, compared, equal, coalesce(with_metrics, 0) = coalesce(members, 0) as metrics_agree
from sp left join p using (trade_date) left join h using (trade_date) left join rw using (trade_date) left join mx using (trade_date)"""


@query(_CALENDAR)
def q6_calendar(spark, sf):
    """Every day of the span with its files, label, holiday, the facts of its rows, and whether as many files have published figures."""
    m = table(spark, sf, "members").where("date_from_filename is not null")
    files = m.select(F.col("date_from_filename").alias("trade_date"), F.col("detected_format").alias("family"), "file_name", "member_id")
    names = F.coalesce(*[F.when((F.month("trade_date") == a) & (F.day("trade_date") == b), n) for a, b, n in HOLIDAYS])
    holidays = cal.spine(files).withColumn("holiday", names).where("holiday is not null")
    days = cal.calendar(files, holidays).join(holidays, "trade_date", "left")
    per_file = files.groupBy("trade_date").agg(F.array_join(F.array_sort(F.collect_list("file_name")), ",").alias("member_names"))  # the files of one day
    modern, stated = F.col("format_family") == "udiff34", F.col("raw_biz_dt")
    facts = rows(spark, sf).groupBy("trade_date").agg(
        F.count("*").alias("row_count"), F.every(F.when(modern, stated.rlike(r"\S"))).alias("compared"), F.every(F.when(modern, stated == F.col("trade_date").cast("string"))).alias("equal")
    )
    metrics = files.join(table(spark, sf, "file_metrics").select("member_id"), "member_id").groupBy("trade_date").agg(F.countDistinct("member_id").alias("with_metrics"))
    j = days.join(per_file, "trade_date", "left").join(facts, "trade_date", "left").join(metrics, "trade_date", "left")
    agree = F.coalesce("with_metrics", F.lit(0)) == F.col("members")
    return j.select(
        "trade_date", "weekday", "file_present", "formats", "member_names", "members", "missing_weekday", "holiday", "label",
        (F.col("holiday").isNotNull() & F.col("file_present")).alias("holiday_with_file"), "row_count", "compared", "equal", agree.alias("metrics_agree"),
    )
