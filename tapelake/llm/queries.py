"""Queries of the text problems: p3, p8, p9, p10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import materialize, table
from . import dedup, mixing, packing, subjects, tokens

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(r"""
with f as (
  select entry_id, row_text, false as staged, regexp_replace(lower(regexp_replace(digest, '^\s+|\s+$', '', 'g')), '^sha256:\s*', '') as d from accepted
  union all select entry_id, row_text, true, regexp_replace(lower(regexp_replace(digest, '^\s+|\s+$', '', 'g')), '^sha256:\s*', '') from staged_candidates),
l as (
  select distinct entry_id, staged, line from (
    select entry_id, staged, regexp_replace(regexp_replace(unnest(string_split(row_text, chr(10))), '^\s+|\s+$', '', 'g'), ',$', '') as line from f) x where line <> ''),
n as (select entry_id, count(*) as n from l group by entry_id),
s as (
  select a.entry_id as entry_id_1, b.entry_id as entry_id_2, count(*) as shared
  from l a join l b on a.line = b.line and a.entry_id < b.entry_id and b.staged group by 1, 2)
select entry_id_1, entry_id_2 from s join n a on a.entry_id = entry_id_1 join n b on b.entry_id = entry_id_2 where shared * 2 >= a.n + b.n - shared
union
select a.entry_id, b.entry_id from f a join f b on a.d = b.d and a.entry_id < b.entry_id and b.staged where regexp_full_match(a.d, '[0-9a-f]{64}')""")
def p3_found(spark, sf):
    return dedup.duplicates(table(spark, sf, "accepted"), table(spark, sf, "staged_candidates"))


@query(r"""
with f as (select entry_id, row_text, false as staged from accepted union all select entry_id, row_text, true from staged_candidates),
l as (
  select distinct entry_id, staged, line from (
    select entry_id, staged, regexp_replace(regexp_replace(unnest(string_split(row_text, chr(10))), '^\s+|\s+$', '', 'g'), ',$', '') as line from f) x where line <> ''),
g as (select entry_id, staged, string_agg(line, chr(10) order by line) as content, count(*) as n from l group by entry_id, staged),
c as (select content, n, min(entry_id) as representative, bool_or(staged) as fresh, count(*) as files from g group by content, n),
d as (select representative, n, fresh, unnest(string_split(content, chr(10))) as line from c),
s as (select a.representative as x, b.representative as y, a.n as n, b.n as m, count(*) as shared from d a
  join d b on a.line = b.line and a.representative <> b.representative and (a.fresh or b.fresh) group by all),
k as (select x, count(*) as links from s where shared * 2 >= n + m - shared group by x)
select entry_id, representative, files, coalesce(links, 0) as links from g join c using (content) left join k on x = representative""")
def p3_classes(spark, sf):
    """Every file with lines: the least entry of its class, the files in it, and the other classes it matches."""
    members, _ = dedup.links(dedup.in_order(table(spark, sf, "accepted"), table(spark, sf, "staged_candidates")))
    of = members.groupBy("class").agg(F.min("entry_id").alias("representative"), F.count("*").alias("files"))
    return members.join(of, "class").select("entry_id", "representative", "files", "links")


@query()
def p8_pack(spark, sf):
    return packing.pack(table(spark, sf, "documents"), table(spark, sf, "pack_sizes"))


@query()
def p8_usage(spark, sf):
    sizes = table(spark, sf, "pack_sizes")
    return packing.usage(packing.pack(table(spark, sf, "documents"), sizes), sizes)


@query("""
select container, documents, 0 as overfull, 0 as misplaced, 0 as split
from (select distinct container from pack_sizes where container is not null and capacity_tokens > 0) k, (select count(*) as documents from documents where text <> '') d where documents > 0""")
def p8_broken(spark, sf):
    """What must hold of the packing; its SQL says how many documents have a place and that nothing is wrong."""
    docs, sizes = table(spark, sf, "documents"), table(spark, sf, "pack_sizes")
    counted = tokens.with_token_counts(docs.select("doc_id", "text"))
    return packing.broken(materialize(packing.pack(docs, sizes)), counted, sizes)


@query()
def p9_selection(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[0]


@query()
def p9_shares(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[1]


@query(r"""
with d as (select lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) as source, count(*) as n from documents where text <> '' group by 1)
select source, coalesce(n, 0) as documents, 0 as too_often, 0 as twice, false as off
from (select distinct lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) as source from mix_targets where source is not null) t left join d using (source)""")
def p9_broken(spark, sf):
    """What must hold of the selection; its SQL says how many documents each source has and that nothing is wrong."""
    targets = table(spark, sf, "mix_targets")
    selection, report = mixing.mix(table(spark, sf, "documents"), targets)
    return mixing.broken(selection, report, targets)


@query()
def p10_found(spark, sf):
    return subjects.subject_shares(table(spark, sf, "documents"), table(spark, sf, "subjects"), table(spark, sf, "subject_labels")).select("doc_id", "subject")


@query()
def p10_composition(spark, sf):
    return subjects.composition(subjects.subject_shares(table(spark, sf, "documents"), table(spark, sf, "subjects"), table(spark, sf, "subject_labels")))


@query()
def p10_mixtures(spark, sf):
    return subjects.mixtures(table(spark, sf, "documents"), table(spark, sf, "subjects"), table(spark, sf, "subject_labels"))
