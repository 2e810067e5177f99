import random

from tapelake.llm import dedup

ACCEPTED = "entry_id bigint, digest string, row_text string, lines string, n int, staged string"
HEX = "ab" * 32


def table(spark, rows, batch=None):
    return spark.createDataFrame([(*r, "c", 1, "d", batch(r[0]) if batch else 1) for r in rows], ACCEPTED + ", batch_no int")


def brute(accepted, staged):
    def digest(d):
        d = (d or "").strip().lower()
        d = d[7:].strip() if d.startswith("sha256:") else d
        return d if len(d) == 64 and not set(d) - set("0123456789abcdef") else None

    def lines(t):
        out = set()
        for x in (t or "").replace("\r\n", "\n").replace("\r", "\n").split("\n"):
            x = x.strip()
            out.add(x[:-1] if x.endswith(",") else x)
        return out - {""}

    every = [(i, digest(d), lines(t), False) for i, d, t in accepted] + [(i, digest(d), lines(t), True) for i, d, t in staged]
    out = set()
    for i, d, x, _ in every:
        for j, e, y, new in every:
            if i < j and new and ((d and d == e) or (x and y and len(x & y) * 2 >= len(x | y))):
                out.add((i, j))
    return out


def some(seed, first, n):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        kind = rnd.random()
        if kind < 0.1:
            text = rnd.choice([None, "", "\n\n", "H,"])
        elif kind < 0.4:
            text = "H,\r\n" + "\r\n".join(f"hot {x}" for x in range(rnd.randrange(1, 9)))
        else:
            base = rnd.randrange(6)
            text = rnd.choice(["H\n", "H,\n"]) + "\n".join(f" row {base} {x}" + rnd.choice(["", ","]) for x in rnd.sample(range(14), rnd.randrange(1, 14)))
        out.append((first + k, rnd.choice([None, "0", "x" * 64, HEX, HEX.upper(), "sha256:" + HEX, f" {k:064x} ", f"{k + seed:064x}"]) if rnd.random() < 0.4 else None, text))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_against_brute_force(spark):
    a, s = some(1, 1, 50), some(2, 100, 40)
    want = brute(a, s)
    assert len(want) > 100
    assert found(dedup.duplicates(table(spark, a), table(spark, s))) == want


def test_batches_one_by_one_and_loaded(spark, tmp_path):
    a, s = some(3, 1, 30), some(4, 100, 24)
    dedup.PrefixIndex.build(table(spark, a), str(tmp_path / "index"))
    got = set()
    for k in range(0, 24, 8):
        index = dedup.PrefixIndex.load(spark, str(tmp_path / "index"))
        pairs, index = index.probe(table(spark, s[k : k + 8]))
        new = found(pairs)
        assert not got & new
        got |= new
        if k == 8:
            index = index.compact(str(tmp_path / "smaller"), 8)
            assert index.deliveries == 1
            assert found(index.probe(table(spark, s[16:]))[0]) == {p for p in brute(a, s) if p[1] >= 116}
    assert got == brute(a, s)


def test_batches_in_any_order(spark):
    a, s = some(5, 1, 20), some(6, 100, 20)
    batches = lambda i: None if i % 5 == 0 else -(i % 3)
    for deliveries in (1, 2, 9):
        assert found(dedup.duplicates(table(spark, a), table(spark, s, batches), deliveries)) == brute(a, s)


def test_a_small_batch_reads_only_its_buckets(spark, tmp_path):
    a = [(i, None, "\n".join(f"{i} {k}" for k in range(6))) for i in range(150)]
    index = dedup.PrefixIndex.build(table(spark, a), str(tmp_path / "index"), rows_a_bucket=8)
    assert index.buckets == 64
    batch = [(1000, None, "\n".join(f"7 {k}" for k in range(5)))]
    seen = []
    whole = dedup.PrefixIndex.read

    def spy(self, name, touched=None):
        df = whole(self, name, touched)
        seen.append((name, touched, df.select("*").count(), len(df.inputFiles())))
        return df

    dedup.PrefixIndex.read = spy
    try:
        pairs, after = index.probe(table(spark, batch))
    finally:
        dedup.PrefixIndex.read = whole
    assert found(pairs) == {(7, 1000)}
    assert {n for n, *_ in seen} == {"counts", "postings", "sets", "members", "digests"}
    for name, touched, rows, _ in seen:
        assert touched is not None and len(touched) <= 6 and rows <= 6 * 30, name
    # The same batch after six times the history: buckets grow with it, rows read do not.
    many = [(i, None, "\n".join(f"{i} {k}" for k in range(6))) for i in range(900)]
    big = dedup.PrefixIndex.build(table(spark, many), str(tmp_path / "big"), rows_a_bucket=8)
    near = big._touched(big._classes(dedup.files(table(spark, batch), True), big.read("counts", [])), "postings", big._prefix(dedup.F.col("lines")))
    small = next(rows for name, _, rows, _ in seen if name == "postings")
    assert big.buckets >= 6 * index.buckets and big.read("postings", near).count() <= 2 * small + 20
    # What was there before stays as it was; the delivery adds files of its own.
    assert after.deliveries == 2 and index.read("postings").count() < after.read("postings").count()


def test_a_broken_delivery_is_written_over(spark, tmp_path):
    a, s = some(8, 1, 20), some(9, 100, 10)
    index = dedup.PrefixIndex.build(table(spark, a), str(tmp_path / "index"))
    classes = index._classes(dedup.files(table(spark, s), True), index.read("counts"))
    index._write("postings", index.postings(classes))  # and then it was lost
    index = dedup.PrefixIndex.load(spark, str(tmp_path / "index"))
    assert index.deliveries == 1
    assert found(index.probe(table(spark, s))[0]) == brute(a, s)


def test_links_without_expansion(spark):
    a = [(i, None, "H\na\nb\nc") for i in range(50)] + [(60, None, "H\na\nb\nd"), (61, "z", None)]
    s = [(100, None, "H,\nb\na\nc"), (101, None, "H\na\nb\ne")]
    index = dedup.in_order(table(spark, a), table(spark, s))
    members, pairs = dedup.links(index)
    got = {r.entry_id: (r["class"], r.links) for r in members.collect()}
    assert len(got) == 53 and got[0] == got[49] == got[100] and got[0][1] == 2 and got[101][1] == 2 and got[60][1] == 2
    assert pairs.count() == 3


def test_long_text_ties_and_empty(spark):
    long = "\n".join(f"line {k}" for k in range(20000))
    a = [(1, None, long), (2, None, "a\nb"), (3, None, "a\nb"), (4, None, "x")]
    s = [(10, None, long + "\nmore"), (11, None, "b\na,"), (12, None, "a\nb\nc\nd"), (13, None, "a\nb\nc\nd\ne"), (11, None, "b\na,")]
    got = found(dedup.duplicates(table(spark, a), table(spark, s)))
    assert got == {(1, 10), (2, 11), (3, 11), (2, 12), (3, 12), (11, 12), (12, 13)}
    assert found(dedup.duplicates(table(spark, []), table(spark, s[1:3]))) == {(11, 12)}
    assert found(dedup.duplicates(table(spark, a), table(spark, []))) == set()
