import io
import json
import os
import zipfile

import pytest

from tapelake import files
from tapelake.operators import increment, package
from tapelake.schema import LEGACY, UDIFF
from tapelake.sources import archive, scans

OLD = ",".join(n for n, _ in LEGACY)
NEW = ",".join(n for n, _ in UDIFF)


def zipped(*members):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return b.getvalue()


def test_members():
    crlf, lf = (archive.read_member(zipped(("a.csv", (OLD + e + "x" + e + e + "y" + e).encode())))[0] | {"lines": archive.read_member(zipped(("a.csv",
        (OLD + e + "x" + e + e + "y" + e).encode())))[1]} for e in ("\r\n", "\n"))
    assert crlf["lines"] == lf["lines"] == ["x", "", "y"] and crlf["member_sha256"] != lf["member_sha256"] and crlf["member_sha256_lf"] == lf["member_sha256_lf"]
    for data, why in ((b"", "empty_member"), (b"\xef\xbb\xbf" + OLD.encode(), "byte_order_mark"), (OLD.encode() + b"\ra", "lone_carriage_return"), (OLD.encode() + b"\n\xff", "invalid_utf8"),
        (b"A,B\n", "unknown_header")):
        assert archive.read_member(zipped(("a.csv", data)))[0]["failure"] == why
    assert archive.read_member(zipped(("a.txt", b"x")))[0]["failure"] == archive.read_member(zipped(("a.csv", b"x"), ("b.CSV", b"x")))[0]["failure"] == "not_exactly_one_csv"
    assert archive.read_member(b"no zip")[0]["failure"] == "unreadable_archive"
    assert [archive.header_variant(h) for h in (OLD, OLD + ",", NEW, OLD + ",,", OLD.lower())] == [("legacy13", 13), ("legacy13", 14), ("udiff34", 34), None, None]


def test_archives_both_ways(spark, tmp_path):
    for path, data in (("legacy/cm20SEP2016bhav.csv.zip", zipped(("a.csv", OLD + "\n1\n2\n"))), ("udiff/B_CM_20240305_f.csv.zip", zipped(("b.csv", NEW + "\r\n3\r\n"))), ("x/bad.zip", b"no")):
        os.makedirs(tmp_path / os.path.dirname(path), exist_ok=True)
        (tmp_path / path).write_bytes(data)
    files = archive.archives(spark, str(tmp_path))
    reports = {r.relative_path: r for r in archive.member_reports(files).collect()}
    assert {k: (r.failure, r.data_lines) for k, r in reports.items()} == {"legacy/cm20SEP2016bhav.csv.zip": (None, 2), "udiff/B_CM_20240305_f.csv.zip": (None, 1),
        "x/bad.zip": ("unreadable_archive", 0)}
    lines = sorted(tuple(r) for r in archive.member_lines(files).collect())
    assert [x[4:] for x in lines] == [(2, "1"), (3, "2"), (2, "3")]
    spark.dataSource.register(archive.ZipMembers)
    assert sorted(tuple(r) for r in spark.read.format("zipmembers").load(str(tmp_path)).collect()) == lines
    assert {(r.relative_path[:4], str(r.file_date)) for r in archive.dated_files(files.select("relative_path")).collect()} == {("lega", "2016-09-20"), ("udif", "2024-03-05"), ("x/ba", "None")}


def test_package(spark, tmp_path):
    df = spark.createDataFrame([(k, "ab"[k % 2], None if k % 5 == 0 else f"t{k}") for k in range(50)], "id int, fam string, text string")
    p = str(tmp_path / "p")
    assert package.write_package(df, p, ["fam"]) == {"partitions": 2, "row_count": 50}
    assert package.verify_package(spark, p).count() == 0 and package.open_package(spark, p).count() == 50
    with pytest.raises(FileExistsError):
        package.write_package(df, p, ["fam"])
    df.where("id = 1").drop("fam").write.mode("append").parquet(f"{p}/rows/fam=c")
    df.where("id = 1").drop("fam").write.mode("append").parquet(f"{p}/rows/fam=a")
    assert {(r.kind, r.fam) for r in package.verify_package(spark, p).collect()} == {("unlisted", "c"), ("different", "a")}
    with pytest.raises(ValueError):
        package.open_package(spark, p)
    os.remove(f"{p}/{package.MARKER}")
    with pytest.raises(FileNotFoundError):
        package.open_package(spark, p)


def test_content_state_ignores_order_and_tells_null_from_empty(spark):
    a = spark.createDataFrame([(1, "x", None), (1, "y", "")], "k int, a string, b string")
    b = spark.createDataFrame([(1, "x", ""), (1, "y", "")], "k int, a string, b string")
    state = lambda d: package.content_state(d, ["k"])
    assert package.compare(state(a), state(a.orderBy("a", ascending=False)), ["k"]).count() == 0
    assert package.compare(state(a), state(b), ["k"]).first().kind == "different"


def test_arrivals(spark):
    s = "path string, name string, date string, digest string"
    accepted = spark.createDataFrame([("n1", "2020-01-01", "d1"), ("n2", "2020-01-05", "d2")], "name string, date string, digest string")
    rows = [("p1", "n1", "2020-01-01", "d1"), ("p2", "n1", "2020-01-01", "zz"), ("p3", "n9", "2020-02-01", "d2"), ("p4", "n8", "2020-01-02", "x"), ("p5", "n7", "2020-02-01", "y"), ("p6", "n6",
        "2020-02-01", None), ("p7", "a", "2020-02-01", "q"), ("p7", "b", "2020-02-02", "r")]
    got = {(r.path, r.name): r.state for r in increment.classify(spark.createDataFrame(rows, s), accepted).collect()}
    assert list(got.values()) and got == {("p1", "n1"): "unchanged", ("p2", "n1"): "conflict", ("p3", "n9"): "dup_content", ("p4", "n8"): "stale", ("p5", "n7"): "new", ("p6", "n6"): "new",
        ("p7", "a"): "dup_path", ("p7", "b"): "dup_path"}
    log = spark.createDataFrame([("n1", "first")], "name string, digest string")
    assert {tuple(r) for r in increment.log_conflicts(log, spark.createDataFrame([("n1", "second"), ("n2", "x")], "name string, digest string"), ["name"]).collect()} == {("n1", "first"), ("n2", "x")}


def test_refresh_equals_full(spark):
    base = spark.createDataFrame([(k % 7, k) for k in range(40)], "id int, v int")
    delta = spark.createDataFrame([(1, 100), (9, 1)], "id int, v int")
    compute = lambda d: d.groupBy("id").agg({"v": "max"}).withColumnRenamed("max(v)", "m")
    got = increment.refresh(base, delta, compute(base), ["id"], compute)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, compute(base.unionByName(delta)).collect()))


def test_generations(spark, tmp_path):
    root = str(tmp_path)
    assert increment.current(spark, root) is None
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, fam string")
    assert increment.publish(df, root, ["fam"]) == 1
    old = increment.snapshot(spark, root)
    assert increment.publish(df.unionByName(df), root, ["fam"]) == 2
    assert (old.count(), increment.snapshot(spark, root).count(), increment.snapshot(spark, root, 1).count()) == (2, 4, 2)
    assert json.load(open(f"{root}/{increment.POINTER}")) == {"generation": 2}


def test_replay_gates(spark, tmp_path):
    df = spark.createDataFrame([(k, "ab"[k % 2], f"t{k}") for k in range(40)], "id int, fam string, text string")
    a, b, c, d = (str(tmp_path / x) for x in "abcd")
    package.write_package(df, a, ["fam"], "run 1", "r5")
    package.write_package(df.orderBy("text", ascending=False), b, ["fam"], "run 2", "r5")
    package.write_package(df.where("id <> 7").unionByName(df.where("id = 9").withColumn("fam", package.F.lit("b"))), c, ["fam"], "run 3", "r5")
    results = lambda x, y: {r.gate: r.result for r in package.qualify_replay(spark, x, y).collect()}
    assert set(results(a, b).values()) == {"pass"} and len(results(a, b)) == 13
    assert {g for g, r in results(a, c).items() if r != "pass"} == {"RQ-13"}
    assert {g for g, r in results(a, a).items() if r != "pass"} == {"RQ-11", "RQ-13"}
    assert results(a, d)["RQ-02"] == "fail" and results(a, d)["RQ-13"] == "not-run"
    assert package.open_partition(spark, a, fam="a").count() == 20
    df.where("id = 1").drop("fam").write.mode("append").parquet(f"{b}/rows/fam=a")
    assert results(a, b)["RQ-02"] == "fail" and package.open_partition(spark, b, fam="b").count() == 20
    with pytest.raises(ValueError):
        package.open_partition(spark, b, fam="a")
    files.write_text(spark, f"{a}/{package.MARKER}", "{}")
    with pytest.raises(ValueError):
        package.open_package(spark, a)


def test_drafts_and_derived(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(10)], "id int, fam string")
    first = increment.create_draft(df, root, ["fam"])
    assert first == increment.create_draft(df.orderBy("id"), root, ["fam"]) and increment.current(spark, root) is None
    assert increment.publish_draft(spark, root, first) == 1 and increment.snapshot(spark, root).count() == 10
    with pytest.raises(ValueError):
        increment.publish_draft(spark, root, first)  # the pointer has moved
    more = spark.createDataFrame([(100 + k, "c") for k in range(5)], "id int, fam string")
    draft = increment.create_draft(more, root, ["fam"])
    for bound in ({"most_rows": 4}, {"most_bytes": 10}):
        with pytest.raises(ValueError):
            increment.publish_draft(spark, root, draft, **bound)
    assert increment.publish_draft(spark, root, draft) == 2 and increment.snapshot(spark, root).count() == 15 and increment.snapshot(spark, root, 1).count() == 10
    said = increment.publish_derived(spark, str(tmp_path / "derived"), {"calendar": (df, ["fam"]), "unresolved": (more, ["fam"])})
    assert said == files.read_document(spark, f"{tmp_path}/derived/{package.MARKER}")["tables"] and said["unresolved"]["row_count"] == 5


def test_refresh_of_linked_keys(spark):
    s = "identity string, series string, ticker string"
    base = spark.createDataFrame([("A", "EQ", "T"), ("B", "EQ", "U"), ("C", "EQ", "V")], s)
    delta = spark.createDataFrame([("B", "EQ", "T"), ("C", "EQ", "V")], s)
    linked = increment.sharing(base, delta, "identity", ["ticker", "series"])
    assert [r.identity for r in linked.collect()] == ["A"]
    compute = lambda df: df.groupBy("identity").count()
    old = spark.createDataFrame([("A", 99), ("B", 99), ("C", 99), ("D", 5)], "identity string, count bigint")
    got = {r.identity: r["count"] for r in increment.refresh(base, delta, old, ["identity"], compute, linked).collect()}
    assert got == {"A": 1, "B": 2, "C": 2, "D": 5}


def test_what_may_be_staged(spark):
    reports = spark.createDataFrame([("a", None), ("b", "empty_member"), ("c", None), ("d", None), ("e", None)], "relative_path string, failure string")
    expected = spark.createDataFrame([("a", "2020-01-01"), ("a", "2020-01-01"), ("b", "2020-01-01"), ("d", "2020-01-01"), ("d", "2020-01-02"), ("e", "2020-01-03"), ("c", None)],
        "relative_path string, file_date string")
    got = {r.relative_path: r.refusal for r in increment.stageable(reports, expected, spark.createDataFrame([("e",)], "relative_path string")).collect()}
    assert got == {"a": None, "b": "unreadable", "c": "undated", "d": "several_dates", "e": "quarantined"}


def test_scans_are_strict(spark, tmp_path):
    def file(name, *lines):
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
        return str(tmp_path / name)

    day = lambda d, n=1, extra="": f'{{"trade_date":"{d}","n":{n}{extra}}}'
    schema = "trade_date date, n int"
    good = file("good.jsonl", day("2020-01-01"), "", day("2020-01-02", "null"))
    assert [r.n for r in scans.read_jsonl(spark, good, schema, "trade_date", ["trade_date"]).collect()] == [1, None]
    for name, lines, options in (
        ("keys", [day("2020-01-01", 1, ',"x":1')], {}), ("less", ['{"n":1}'], {}), ("broken", ["{"], {}), ("type", [day("2020-01-01", '"a"')], {}), ("date", [day("2020-13-01")], {}),
        ("order", [day("2020-01-02"), day("2020-01-01")], {"ascending": "trade_date"}), ("same", [day("2020-01-01"), day("2020-01-01")], {"ascending": "trade_date"}),
        ("twice", [day("2020-01-01"), day("2020-01-01")], {"unique": ["n", "trade_date"]}),
    ):
        with pytest.raises(scans.ScanError):
            scans.read_jsonl(spark, file(name, *lines), schema, **options)
    assert scans.read_jsonl(spark, str(tmp_path / "none"), schema, missing_ok=True).count() == 0
    import hashlib

    digest = hashlib.sha256((tmp_path / "good.jsonl").read_bytes()).hexdigest()
    assert scans.pinned(spark, good, digest, 2) == good
    for bad in (("0" * 64, None), (digest, 3)):
        with pytest.raises(scans.ScanError):
            scans.pinned(spark, good, *bad)
    table = file("m.csv", "file,rows", "a,1", "b,2")
    assert scans.read_csv(spark, table, "file string, rows int").agg({"rows": "sum"}).first()[0] == 3
    with pytest.raises(scans.ScanError):
        scans.read_csv(spark, table, "rows int, file string")
    labels = file("l.json", '{"per_missing_day":[{"missing_date":"2020-01-26","label":"x","circular":"REG/1"},{"missing_date":"2020-03-01","label":"y","circular":null}],"holidays_with_file":[{"holiday_per_circular":"2020-10-21","bhav_file":"f","note":""}]}')
    missing, holidays = scans.read_labels(spark, labels)
    assert [(str(r.missing_date), r.registry_id) for r in missing.collect()] == [("2020-01-26", "REG/1"), ("2020-03-01", None)] and str(holidays.first().holiday) == "2020-10-21"
    classes = file("c.csv", "series,provisional_class,classification_basis", "EQ,EQUITY,legend")
    assert scans.read_series_classes(spark, classes).first()["class"] == "EQUITY"
    with pytest.raises(scans.ScanError):
        scans.read_series_classes(spark, table)
