"""Schemas that drift between files: header reading, change log, one consistent table.

Each file is read on its own row: names and kinds of its columns are array expressions, without a
shuffle. Only these narrow headers travel to the windows that pair a file with the one before it
in its feed, month by month, so that no feed meets in one task; bodies are looked at again only for the few files whose gone and new names have to
be told apart by their values. Kinds fold through the lattice integer < decimal < text and
date < text.

Nulls: a file without header has no columns; without body its columns have no kind; a null
delimiter is a comma. Empty column names and repeats of a name within a file (the first counts)
are ignored. A column without values has no kind and is never retyped. Where several gone columns
could be the new one, listed names win, then the greater share of shared values, then the earlier
columns; each name takes part in one renaming. Extra columns are ignored.

Under one set of names a listed name stands for its canonical field. A name that is not listed
follows the renamings of its feed, from the file that brought it; files before the first renaming
into it take that one or, failing it, the first renaming out of it. Names without any keep their own.
Where a file has the field under a listed name or an earlier column too, the name keeps its own.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTHS
from ..functions.text import strip
from ..session import broadcast_if_small, materialize
from .ordering import with_previous

KIND_PATTERNS = (
    ("integer", r"^-?[0-9]+\z"),
    ("decimal", r"^-?[0-9]+(?:\.[0-9]+)?\z"),
    ("date", r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}-(?i:" + "|".join(MONTHS) + r")-[0-9]{4})\z"),
)
#: The lattice of kinds as bit sets: the least kind that holds two is the union of their bits, and what has no name of its own is text.
LATTICE = {"integer": 0b001, "decimal": 0b011, "date": 0b100, "text": 0b111}
_TOP = LATTICE["text"]


def promote(a: str | None, b: str | None) -> str | None:
    """Least kind that holds both; null is the bottom of the lattice."""
    bits = LATTICE.get(a, 0) | LATTICE.get(b, 0)
    return next((k for k, v in LATTICE.items() if v == bits), "text") if bits else None


def kind_of(bits: Column) -> Column:
    """Name of a folded bit set."""
    out = F.when(F.coalesce(bits, F.lit(0)) == 0, None)
    for kind, v in LATTICE.items():
        out = out.when(bits == v, kind)
    return out.otherwise("text")


def bits_of(kind: Column) -> Column:
    """Bit set of a kind, 0 for none."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in LATTICE.items() for x in kv])[kind], F.lit(0))


def _split(text: Column, delim: Column) -> Column:
    return F.split(text, F.concat(F.lit("\\Q"), F.coalesce(delim, F.lit(",")), F.lit("\\E")), F.lit(-1))


def clean_name(c: Column) -> Column:
    """Trimmed, without quotes and byte order mark, lower case."""
    return F.lower(strip(F.regexp_replace(c, '["﻿]|^ï»¿', "")))


def _cells(body: Column, delim: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(body, F.lit("")), "\n"), lambda r: ~r.rlike(r"^\s*$"))
    return F.transform(lines, lambda r: _split(r, delim))


def _values(cells: Column, pos: Column) -> Column:
    """Distinct non-empty values of the column at `pos` (from 0)."""
    return F.array_distinct(F.filter(F.transform(cells, lambda r: strip(F.get(r, pos))), lambda v: v.isNotNull() & (v != "")))


def _value_bits(v: Column) -> Column:
    """Bit set of the least kind of one value."""
    out = F.lit(_TOP)
    for kind, pattern in reversed(KIND_PATTERNS):
        out = F.when(v.rlike(pattern), LATTICE[kind]).otherwise(out)
    return out


def _kind(values: Column) -> Column:
    """Kind of a column: its values folded through the lattice."""
    return kind_of(F.aggregate(values, F.lit(0), lambda bits, v: F.when(bits == _TOP, bits).otherwise(bits.bitwiseOR(_value_bits(v)))))


def headers(files: DataFrame) -> DataFrame:
    """file_id, feed, file_date, cols array<struct<name, pos, kind>>: the columns of each file in their order."""
    names = F.transform(_split(F.coalesce("header_line", F.lit("")), F.col("delim")), lambda n, i: F.struct(clean_name(n).alias("name"), i.cast("int").alias("pos")))
    df = files.select("file_id", "feed", "file_date", names.alias("names"), F.explode(F.array(_cells(F.col("body"), F.col("delim")))).alias("cells"))
    usable = F.filter("names", lambda c, i: (c["name"] != "") & ~F.exists(F.slice("names", F.lit(1), i), lambda d: d["name"] == c["name"]))
    filled = F.transform(usable, lambda c: F.struct(c["name"].alias("name"), c["pos"].alias("pos"), _values(F.col("cells"), c["pos"]).alias("values")))
    df = df.select("file_id", "feed", "file_date", F.explode(F.array(filled)).alias("filled"))
    cols = F.transform("filled", lambda c: F.struct(c["name"].alias("name"), c["pos"].alias("pos"), _kind(c["values"]).alias("kind")))
    return df.select("file_id", "feed", "file_date", cols.alias("cols"))


def known_names(field_names: DataFrame) -> dict[str, str]:
    """Canonical field of every known name (clean). The list of names is a fixed dictionary, not data."""
    rows = field_names.select(clean_name(F.col("field_name")).alias("n"),
        "canonical_field").where("n is not null and canonical_field is not null").groupBy("n").agg(F.min("canonical_field").alias("c")).collect()
    return {r["n"]: r["c"] for r in rows}


def canonical_map(field_names: DataFrame) -> Column:
    """`known_names` as a map literal."""
    pairs = [F.lit(x) for nc in known_names(field_names).items() for x in nc] or [F.lit(""), F.lit(None).cast("string")]
    return F.create_map(*pairs)


def _greedy(pairs: Column) -> Column:
    """Of pairs in order of preference, those whose names are not taken by an earlier one."""
    empty = F.filter(pairs, lambda p: F.lit(False))
    free = lambda taken, p: ~F.exists(taken, lambda t: (t["old"] == p["old"]) | (t["new"] == p["new"]))
    return F.aggregate(pairs, empty, lambda taken, p: F.when(free(taken, p), F.concat(taken, F.array(p))).otherwise(taken))


def change_log(files: DataFrame, field_names: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """file_id, change_kind, old_name, new_name, old_kind, new_kind of every file against the one before it in its feed. heads: `headers` of the files, if they are written already."""
    known = canonical_map(field_names)
    month = F.year("file_date") * 12 + F.month("file_date")
    # Written once: the bodies are read for their kinds a single time.
    step = with_previous(heads or materialize(headers(files)), "feed", month, ["file_date", "file_id"], ["file_id", "cols"])
    step = step.where("previous is not null").select("file_id", "cols", F.col("previous.file_id").alias("prev_id"), F.col("previous.cols").alias("prev"))
    lacks = lambda cols, name: ~F.exists(cols, lambda d: d["name"] == name)
    step = step.select(
        "file_id", "prev_id", "cols", "prev",
        F.filter("prev", lambda c: lacks(F.col("cols"), c["name"])).alias("gone"),
        F.filter("cols", lambda c: lacks(F.col("prev"), c["name"])).alias("new"),
        F.filter("cols", lambda c: F.exists("prev", lambda d: (d["name"] == c["name"]) & (d["kind"] != c["kind"]))).alias("other_kind"),
    ).where(F.size("gone") + F.size("new") + F.size("other_kind") > 0)
    pair = lambda g, n: F.struct(g.alias("old_col"), n.alias("new_col"), known[g["name"]].alias("g"), known[n["name"]].alias("n"))
    pairs = F.flatten(F.transform("gone", lambda g: F.transform("new", lambda n: pair(g, n))))
    step = step.withColumn("pairs", pairs)
    listed = F.filter("pairs", lambda p: p["g"].isNotNull() & p["n"].isNotNull() & (p["g"] == p["n"]))
    unclear = F.filter("pairs", lambda p: p["g"].isNull() | p["n"].isNull())
    step = step.select("*", listed.alias("listed"), unclear.alias("unclear"))

    # Values are compared only for names that the dictionary leaves open. Each body that is asked for is read once, and only values of the asked columns go on.
    ask = step.where(F.size("unclear") > 0).select("file_id", "prev_id", F.col("unclear").alias("u"))
    places = lambda side: F.transform("u", lambda p: p[side]["pos"])
    sides = F.array(F.struct(F.col("file_id").alias("id"), F.lit(True).alias("is_new"), places("new_col").alias("at")), F.struct(F.col("prev_id").alias("id"), F.lit(False).alias("is_new"),
        places("old_col").alias("at")))
    need = ask.select("file_id", F.explode(sides).alias("s")).select("file_id", "s.*")
    text = files.select(F.col("file_id").alias("id"), "delim", "body")
    got = need.join(text, "id").select("file_id", "is_new", "at", F.explode(F.array(_cells(F.col("body"), F.col("delim")))).alias("cells"))
    got = got.select("file_id", "is_new", F.transform("at", lambda i: _values(F.col("cells"), i)).alias("values"))
    got = got.groupBy("file_id").agg(F.max(F.when(F.col("is_new"), F.col("values"))).alias("new_values"), F.max(F.when(~F.col("is_new"), F.col("values"))).alias("old_values"))
    share = lambda o, n: F.size(F.array_intersect(n, o)) / F.greatest(F.size(n), F.lit(1))
    scored = ask.join(got, "file_id").select("file_id", F.transform("u", lambda p, i: F.struct(p["old_col"].alias("old_col"), p["new_col"].alias("new_col"), share(F.get("old_values", i),
        F.get("new_values", i)).alias("share"))).alias("u"))
    scored = scored.select("file_id", F.filter("u", lambda p: p["share"] >= 0.5).alias("by_value"))

    shape = lambda p, s: F.struct(
        (-s).alias("rank"), p["old_col"]["pos"].alias("at"), p["new_col"]["pos"].alias("to"),
        p["old_col"]["name"].alias("old"), p["new_col"]["name"].alias("new"), p["old_col"]["kind"].alias("old_kind"), p["new_col"]["kind"].alias("new_kind"),
    )
    joined = step.join(scored, "file_id", "left")
    none = F.filter(F.transform("listed", lambda p: shape(p, F.lit(2.0))), lambda p: F.lit(False))
    ranked = F.array_sort(F.concat(F.transform("listed", lambda p: shape(p, F.lit(2.0))), F.coalesce(F.transform("by_value", lambda p: shape(p, p["share"])), none)))
    joined = joined.select("*", F.explode(F.array(ranked)).alias("ranked"))
    joined = joined.select("*", F.explode(F.array(_greedy(F.col("ranked")))).alias("renamed"))
    log = lambda kind, old, new, k0, k1: F.struct(F.lit(kind).alias("change_kind"), old.alias("old_name"), new.alias("new_name"), k0.alias("old_kind"), k1.alias("new_kind"))
    nothing, no_kind = F.lit(""), F.lit(None).cast("string")
    before = lambda name: F.filter("prev", lambda d: d["name"] == name)[0]["kind"]
    changes = F.concat(
        F.transform("renamed", lambda p: log("renamed", p["old"], p["new"], p["old_kind"], p["new_kind"])),
        F.transform(F.filter("new", lambda c: ~F.exists("renamed", lambda r: r["new"] == c["name"])), lambda c: log("added", nothing, c["name"], no_kind, c["kind"])),
        F.transform(F.filter("gone", lambda c: ~F.exists("renamed", lambda r: r["old"] == c["name"])), lambda c: log("removed", c["name"], nothing, c["kind"], no_kind)),
        F.transform("other_kind", lambda c: log("retyped", c["name"], c["name"], before(c["name"]), c["kind"])),
        F.transform(F.filter("renamed", lambda r: r["old_kind"] != r["new_kind"]), lambda p: log("retyped", p["old"], p["new"], p["old_kind"], p["new_kind"])),
    )
    return joined.select("file_id", F.explode(changes).alias("x")).select("file_id", "x.*")


_FIRST = -(1 << 62)


def _follow(known: dict[str, str]):
    """Function of the renamings of a feed that touch unlisted names: the field of each such name from a file on."""

    def run(pdf):
        cur, out = {}, []

        def at(name, node, day=_FIRST, file_id=_FIRST):
            if name not in cur and day != _FIRST:
                out.append((name, _FIRST, _FIRST, node))
            out.append((name, day, file_id, node))
            cur[name] = node

        for e in pdf.sort_values(["day", "file_id"]).itertuples():
            if e.old_name in known:
                at(e.new_name, {"field": known[e.old_name]}, e.day, e.file_id)
                continue
            if e.old_name not in cur:
                at(e.old_name, {"root": e.old_name})
            node = cur[e.old_name]
            if e.new_name in known:
                node.setdefault("field", known[e.new_name])
            else:
                at(e.new_name, node, e.day, e.file_id)
        feed = pdf["feed"].iloc[0]
        return pd.DataFrame([(feed, n, d, f, x.get("field") or x["root"]) for n, d, f, x in out], columns=["feed", "name", "day", "since", "field"])

    return run


def renamings(heads: DataFrame, log: DataFrame, field_names: DataFrame) -> DataFrame:
    """file_id, renamed map<unlisted name, field>: files with names that the renamings of their feed explain, from `headers` and `change_log`.

    Only renamings of unlisted names meet by feed, a narrow row each.
    """
    known = known_names(field_names)
    listed = canonical_map(field_names)
    day = F.coalesce(F.unix_date("file_date").cast("bigint"), F.lit(_FIRST + 1)).alias("day")
    open_names = log.where("change_kind = 'renamed'").where(listed[F.col("old_name")].isNull() | listed[F.col("new_name")].isNull()).select("file_id", "old_name", "new_name")
    events = open_names.join(heads.select("file_id", "feed", day), "file_id")
    since = events.groupBy("feed").applyInPandas(_follow(known), "feed string, name string, day bigint, since bigint, field string")
    since = since.select(F.col("feed").alias("_feed"), F.col("name").alias("_name"), F.struct("day", "since").alias("_since"), "field")
    names = heads.select("file_id", "feed", F.struct(day, "file_id").alias("at"), F.explode("cols.name").alias("name")).where(listed[F.col("name")].isNull())
    hit = names.join(broadcast_if_small(since), F.col("feed").eqNullSafe(F.col("_feed")) & (F.col("name") == F.col("_name")) & (F.col("_since") <= F.col("at")))
    last = hit.groupBy("file_id", "name").agg(F.max_by("field", "_since").alias("field")).where("field <> name")
    return last.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "field"))).alias("renamed"))


def _keys(names: Column, listed: Column, renamed: Column) -> Column:
    """Field or own name of each of `names`."""

    def key(n, i):
        f = renamed[n]
        taken = F.exists(names, lambda m: F.coalesce(listed[m], m) == f)
        earlier = F.exists(F.slice(names, F.lit(1), i), lambda m: (m != n) & (renamed[m] == f))
        return F.coalesce(listed[n], F.when(f.isNotNull() & ~F.coalesce(taken, F.lit(False)) & ~F.coalesce(earlier, F.lit(False)), f), n)

    return F.transform(names, key)


def _renamed(files: DataFrame, field_names: DataFrame, heads: DataFrame) -> DataFrame:
    return materialize(renamings(heads, change_log(files, field_names, heads), field_names))


def union_schema(files: DataFrame, field_names: DataFrame, heads: DataFrame | None = None, renamed: DataFrame | None = None) -> DataFrame:
    """feed, field, kind, files, first_file, last_file: the union schema of each feed, kinds folded through the lattice. heads, renamed: `headers` and `renamings`, if they are written already."""
    heads = heads or materialize(headers(files))
    renamed = renamed or _renamed(files, field_names, heads)
    keys = _keys(F.col("cols.name"), canonical_map(field_names), F.col("renamed"))
    cols = heads.join(renamed, "file_id", "left").select("feed", "file_id", "cols", F.explode(F.array(keys)).alias("keys"))
    cols = cols.select("feed", "file_id", F.explode(F.arrays_zip("keys", F.col("cols.kind").alias("kinds"))).alias("c")).select("feed", "file_id", F.col("c.keys").alias("field"),
        F.col("c.kinds").alias("kind"))
    folded = cols.groupBy("feed", "field").agg(F.bit_or(bits_of(F.col("kind"))).alias("bits"), F.countDistinct("file_id").alias("files"), F.min("file_id").alias("first_file"),
        F.max("file_id").alias("last_file"))
    return folded.select("feed", "field", kind_of(F.col("bits")).alias("kind"), "files", "first_file", "last_file")


def consistent_table(files: DataFrame, field_names: DataFrame, renamed: DataFrame | None = None) -> DataFrame:
    """file_id, feed, line_number, fields map<canonical field or name, text>: every body line of every file under one set of names."""
    renamed = renamed or _renamed(files, field_names, materialize(headers(files)))
    names = F.transform(_split(F.coalesce("header_line", F.lit("")), F.col("delim")), clean_name)
    keyed = files.join(renamed, "file_id", "left").select("file_id", "feed", "delim", "body", "renamed", F.explode(F.array(names)).alias("names"))
    keyed = keyed.select("file_id", "feed", "delim", "body", F.explode(F.array(_keys(F.col("names"), canonical_map(field_names), F.col("renamed")))).alias("keys"))
    lines = keyed.select("file_id", "feed", "delim", "keys", F.posexplode(F.filter(F.split("body", "\n"), lambda r: ~r.rlike(r"^\s*$"))).alias("at", "line"))
    lines = lines.select("*", F.explode(F.array(_split(F.col("line"), F.col("delim")))).alias("cells"))
    entry = F.transform("keys", lambda k, i: F.struct(k.alias("key"), F.get("cells", i).alias("value")))
    usable = lines.select("file_id", "feed", (F.col("at") + 1).alias("line_number"), F.explode(F.array(entry)).alias("e"))
    first = F.filter("e", lambda c, i: (c["key"] != "") & ~F.exists(F.slice("e", F.lit(1), i), lambda d: d["key"] == c["key"]))
    return usable.select("file_id", "feed", "line_number", F.map_from_entries(first).alias("fields"))


_DAY = lambda c: F.coalesce(F.when(c.rlike(r"^\d{4}-"), c.try_cast("date")), F.try_to_date(F.initcap(c), "dd-MMM-yyyy"))
_CASTS = {"integer": lambda c: c.try_cast("bigint"), "decimal": lambda c: c.try_cast("decimal(38,10)"), "date": _DAY, "text": lambda c: c}


def cast_to_schema(rows: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Rows of `consistent_table` as columns of a union schema [(field, kind)], and `other`, the fields that it does not name.

    What does not cast (empty cells, more digits than the type holds) is null.
    """
    cast = lambda f, k: _CASTS[k or "text"](strip(F.col("fields")[f]) if k not in (None, "text") else F.col("fields")[f]).alias(f)
    names = F.array(*[F.lit(f) for f, _ in schema]) if schema else F.array().cast("array<string>")
    other = F.map_filter("fields", lambda f, v: ~F.array_contains(names, f))
    return rows.select("file_id", "feed", "line_number", *[cast(f, k) for f, k in schema], other.alias("other"))


def typed_table(files: DataFrame, field_names: DataFrame) -> DataFrame:
    """Every body line of every file cast to the union schema of all feeds: a typed column for each field of the dictionary in use, and `other` map<name, text>.

    The kinds of the feeds fold through the same lattice as those of their files. A field that the
    table already uses as a name of its own (file_id, feed, line_number, other) stays in `other`.
    """
    heads = materialize(headers(files))
    renamed = _renamed(files, field_names, heads)
    listed = set(known_names(field_names).values()) - {"file_id", "feed", "line_number", "other"}
    by_feed = union_schema(files, field_names, heads, renamed)
    folded = by_feed.where(F.col("field").isin(sorted(listed))).groupBy("field").agg(kind_of(F.bit_or(bits_of(F.col("kind")))).alias("kind"))
    schema = sorted((r["field"], r["kind"]) for r in folded.collect())  # at most the fields of the dictionary
    return cast_to_schema(consistent_table(files, field_names, renamed), schema)
