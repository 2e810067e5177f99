import random
import re

from tapelake.operators import drift

FILES = "file_id bigint, feed string, file_name string, file_date string, delim string, header_line string, body string, cols string, names string"
KNOWN = [("sym", "SYMBOL"), ("sym", "Tckr"), ("qty", "VOL"), ("qty", "TotVol"), ("date", "TIMESTAMP"), (None, "zz"), ("date", None)]


def frames(spark, files):
    f = spark.createDataFrame([(*x, "c", "n") for x in files], FILES).selectExpr("*", "cast(file_date as date) d").drop("file_date").withColumnRenamed("d", "file_date")
    return f, spark.createDataFrame(KNOWN, "canonical_field string, field_name string")


def kind(values):
    for name, pattern in (("integer", r"-?[0-9]+"), ("decimal", r"-?[0-9]+(\.[0-9]+)?"), ("date", r"\d{4}-\d\d-\d\d|\d\d-[A-Za-z]{3}-\d{4}")):
        if values and all(re.fullmatch(pattern, v) for v in values):
            return name
    return "text" if values else None


def brute(files):
    known = {n.lower(): c for c, n in KNOWN if n and c}
    out, last = set(), {}
    for fid, feed, _, date, delim, header, body in sorted(files, key=lambda x: (x[1], x[3] or "", x[0])):
        names = [n.replace('"', "").replace("﻿", "").strip().lower() for n in (header or "").split(delim or ",")]
        cells = [r.split(delim or ",") for r in (body or "").split("\n") if r.strip()]
        cols = {}
        for i, n in enumerate(names):
            if n and n not in cols:
                v = {r[i].strip() for r in cells if len(r) > i} - {""}
                cols[n] = (v, kind(v))
        if feed in last:
            old = last[feed]
            gone, new = [n for n in old if n not in cols], [n for n in cols if n not in old]
            pairs = []
            for g in gone:
                for n in new:
                    a, b = known.get(g), known.get(n)
                    if a and b:
                        score = 2 if a == b else 0
                    else:
                        score = len(cols[n][0] & old[g][0]) / max(1, len(cols[n][0]))
                    if score >= 0.5:
                        pairs.append((-score, list(old).index(g), list(cols).index(n), g, n))
            done = {}
            for *_, g, n in sorted(pairs):
                if g not in done and n not in done.values():
                    done[g] = n
            out |= {(fid, "renamed", g, n) for g, n in done.items()} | {(fid, "removed", g, "") for g in gone if g not in done} | {(fid, "added", "", n) for n in new if n not in done.values()}
            for g, n in [*done.items(), *((n, n) for n in cols if n in old)]:
                if old[g][1] and cols[n][1] and old[g][1] != cols[n][1]:
                    out.add((fid, "retyped", g, n))
        last[feed] = cols
    return out


def test_against_brute_force(spark):
    rnd = random.Random(5)
    names = ["SYMBOL", "Tckr", "VOL", "TotVol", "TIMESTAMP", "x", "y", "Z ", "", '"x"']
    files = []
    for k in range(60):
        delim = rnd.choice([",", ";", "|", "\t", None])
        head = rnd.sample(names, rnd.randrange(0, 7))
        value = lambda h: rnd.choice(["1", "2", "", "3.5", "2020-01-02", "02-JAN-2020", "a"] if h in "xyZ " else [f"{h[:1]}1", f"{h[:1]}2", "1"])
        body = "\n".join((delim or ",").join(value(h) for h in head) for _ in range(rnd.randrange(4)))
        files.append((k, rnd.choice("fg"), "n", f"2020-01-{rnd.randrange(1, 28):02d}" if k % 13 else None, delim, ("﻿" if k % 7 == 0 else "") + (delim or ",").join(head) if k % 11 else None,
            body if k % 9 else None))
    f, known = frames(spark, files)
    got = [tuple(r)[:4] for r in drift.change_log(f, known).select("file_id", "change_kind", "old_name", "new_name").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(files)


def test_real_files_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    f, n = spark.read.parquet(f"{d}/feed_files.parquet"), spark.read.parquet(f"{d}/field_names.parquet")
    global KNOWN
    keep, KNOWN = KNOWN, [tuple(r) for r in n.select("canonical_field", "field_name").collect()]
    try:
        want = brute([(r.file_id, r.feed, r.file_name, str(r.file_date), r.delim, r.header_line, r.body) for r in f.collect()])
    finally:
        KNOWN = keep
    assert {tuple(r) for r in drift.change_log(f, n).select("file_id", "change_kind", "old_name", "new_name").collect()} == want


def test_empty_inputs_and_table(spark):
    f, known = frames(spark, [(1, "f", "n", "2020-01-01", ",", "SYMBOL,VOL,x", "a,1,2\n\nb,2"), (2, "f", "n", "2020-01-02", ",", "Tckr,VOL,x", "c,2.5,02-JAN-2020")])
    assert drift.change_log(f.limit(0), known).count() == 0 and drift.change_log(f, known.limit(0)).count() > 0
    rows = {(r.file_id, r.line_number): r.fields for r in drift.consistent_table(f, known).collect()}
    assert rows == {(1, 1): {"sym": "a", "qty": "1", "x": "2"}, (1, 2): {"sym": "b", "qty": "2", "x": None}, (2, 1): {"sym": "c", "qty": "2.5", "x": "02-JAN-2020"}}
    schema = {r.field: r.kind for r in drift.union_schema(f, known).collect()}
    assert schema == {"sym": "text", "qty": "decimal", "x": "text"}
    cast = drift.cast_to_schema(drift.consistent_table(f, known), [("sym", "text"), ("qty", "decimal"), ("x", "date")]).orderBy("file_id", "line_number").collect()
    assert [str(r.x) for r in cast] == ["None", "None", "2020-01-02"] and float(cast[2].qty) == 2.5 and cast[0].other == {}
    typed = drift.typed_table(f, known).orderBy("file_id", "line_number")
    assert typed.columns == ["file_id", "feed", "line_number", "qty", "sym", "other"] and dict(typed.dtypes)["qty"] == "decimal(38,10)"
    assert [(float(r.qty), r.sym, r.other) for r in typed.collect()] == [(1.0, "a", {"x": "2"}), (2.0, "b", {"x": None}), (2.5, "c", {"x": "02-JAN-2020"})]
    assert drift.typed_table(f.limit(0), known).count() == 0


def test_lattice():
    kinds = [None, "integer", "decimal", "date", "text"]
    for a in kinds:
        for b in kinds:
            assert drift.promote(a, b) == drift.promote(b, a)
            for c in kinds:
                assert drift.promote(drift.promote(a, b), c) == drift.promote(a, drift.promote(b, c))


def test_fold_is_the_lattice(spark):
    from functools import reduce

    from pyspark.sql import functions as F

    kinds = [None, "integer", "decimal", "date", "text"]
    rows = [(i, k) for i, ks in enumerate((a, b, c) for a in kinds for b in kinds for c in kinds) for k in ks]
    df = spark.createDataFrame(rows, "i int, kind string").groupBy("i").agg(drift.kind_of(F.bit_or(drift.bits_of(F.col("kind")))).alias("k"))
    want = {i: reduce(drift.promote, [k for j, k in rows if j == i]) for i in {i for i, _ in rows}}
    assert {r.i: r.k for r in df.collect()} == want


def test_previous_across_chunks(spark):
    from pyspark.sql import functions as F

    from tapelake.operators.ordering import with_previous

    rnd = random.Random(2)
    rows = [(k, rnd.choice(["a", "b", None]), rnd.choice([None, *range(40)])) for k in range(200)]
    df = spark.createDataFrame(rows, "id int, key string, at int")
    got = {r.id: r.previous and r.previous.id for r in with_previous(df, "key", F.floor(F.col("at") / 7), ["at", "id"], ["id"]).collect()}
    want = {}
    for key in ("a", "b", None):
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (-1 if r[2] is None else r[2], r[0]))
        want |= {r[0]: p and p[0] for p, r in zip([None, *mine], mine)}
    assert got == want


def test_unlisted_names_follow_the_renamings(spark):
    line = lambda k, head, body: (k, "f", "n", f"2020-01-{k:02d}", ",", head, body)
    files = [
        line(1, "grp,VOL,desk", "EQ,1,x\nBE,2,x"), line(2, "SYMBOL,VOL,desk", "EQ,3,x\nBE,4,x"), line(3, "scrip,VOL,desk", "EQ,5,x\nBE, ,x"), line(4, "code,VOL,desk", "EQ,6.5,x\nBE,7,x"),
        line(5, "code,SYMBOL,VOL", "a,EQ,1\nb,BE,2"), (6, "g", "n", "2020-01-06", ",", "scrip,VOL", "EQ,1"),
        (7, "h", "n", "2020-01-01", ",", "u,VOL", "EQ,1"), (8, "h", "n", "2020-01-02", ",", "w,VOL", "EQ,1"),
    ]
    f, known = frames(spark, files)
    rows = {(r.file_id, r.line_number): r for r in drift.consistent_table(f, known).collect()}
    typed = {(r.file_id, r.line_number): r for r in drift.typed_table(f, known).collect()}
    assert [rows[k, 1].fields.get("sym") for k in range(1, 6)] == ["EQ"] * 5
    assert rows[5, 1].fields == {"code": "a", "sym": "EQ", "qty": "1"} and rows[6, 1].fields == {"scrip": "EQ", "qty": "1"}
    assert rows[7, 1].fields == rows[8, 1].fields == {"u": "EQ", "qty": "1"}
    assert (float(typed[1, 1].qty), typed[3, 2].qty, float(typed[4, 1].qty), typed[5, 1].sym, typed[5, 1].other) == (1.0, None, 6.5, "EQ", {"code": "a"})
    schema = {(r.feed, r.field): (r.kind, r.files) for r in drift.union_schema(f, known).collect()}
    assert schema == {("f", "sym"): ("text", 5), ("f", "qty"): ("decimal", 5), ("f", "desk"): ("text", 4), ("f", "code"): ("text", 1), ("g", "scrip"): ("text", 1), ("g", "qty"): ("integer", 1),
        ("h", "u"): ("text", 2), ("h", "qty"): ("integer", 2)}
