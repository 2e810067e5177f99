import random

import pytest

from tapelake.llm import mixing, packing, tokens

DOCS = "doc_id bigint, text string, source string, n_tokens string, container string, h string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], DOCS)


def some(n=400):
    rnd = random.Random(7)
    out = []
    for k in range(n):
        text = rnd.choice([None, ""]) if k % 29 == 0 else ("word " * 37 if k % 3 == 0 else "word " * int(rnd.expovariate(1 / 60) + 1))
        out.append((k, text, rnd.choice([" A ", "b", "B", "c", None])))
    return out + [(n, "long " * 5000, "a"), (n + 1, "x" * 50000, "c")]


@pytest.fixture(scope="module")
def counts():
    e = tokens.encoding()
    return lambda text: len(e.encode_ordinary(text)) if text else 0


def sizes(spark):
    return spark.createDataFrame([("s", 64, 1), ("m", 512, 1), (None, 5, 1), ("zero", 0, 1)], "container string, capacity_tokens bigint, piece int")


def test_every_token_has_one_place(spark, counts):
    rows = some()
    packed = packing.pack(docs(spark, rows), sizes(spark)).collect()
    want = {i: counts(t) for i, t, _ in rows if counts(t)}
    for name, capacity in (("s", 64), ("m", 512)):
        load, spans = {}, {}
        for r in packed:
            if r.container == name:
                load[r.container_no] = load.get(r.container_no, 0) + r.length
                spans.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
        assert max(load.values()) <= capacity and set(load) == set(range(len(load)))
        assert set(spans) == set(want)
        for i, parts in spans.items():
            parts.sort()
            assert parts[0][0] == 0 and parts[-1][1] == want[i] and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
            assert len(parts) == 1 or want[i] > capacity
        assert 1 - sum(want.values()) / (capacity * len(load)) < (0.12 if name == "s" else 0.03)
    use = {r.container: r for r in packing.usage(packing.pack(docs(spark, rows), sizes(spark)), sizes(spark)).collect()}
    assert use["m"].tokens == sum(want.values())


def test_pack_empty_and_repeated(spark):
    assert packing.pack(docs(spark, []), sizes(spark)).count() == 0
    assert packing.pack(docs(spark, [(1, None, "a"), (2, "", "a")]), sizes(spark)).count() == 0
    assert packing.pack(docs(spark, [(1, "one two", "a")] * 5), sizes(spark)).where("container = 's'").count() == 5
    assert packing.pack(docs(spark, [(1, "one two", "a")]), sizes(spark).limit(0)).count() == 0


@pytest.mark.parametrize("capacity,seed", [(8, 1), (50, 2), (256, 3), (1000, 4)])
def test_plan_uses_up_the_histogram(capacity, seed):
    rnd = random.Random(seed)
    h = {a: rnd.choice([1, 2, 3, 1000]) for a in rnd.sample(range(1, capacity + 1), min(capacity, 40))}
    plan = packing.plan(dict(h), capacity)
    load, taken = {}, dict.fromkeys(h, 0)
    for length, first, after, base, each in sorted(plan):
        assert first == taken[length] and (after - first) % each == 0
        taken[length] = after
        for k in range((after - first) // each):
            load[base + k] = load.get(base + k, 0) + length * each
    assert taken == h and max(load.values()) <= capacity
    total = sum(a * n for a, n in h.items())
    assert len(load) <= max(total / capacity * 1.7, sum(n for a, n in h.items() if a * 2 > capacity) * 1.05 + total / capacity) + 2
    assert packing.plan({}, capacity) == []


def test_an_item_meets_few_parts_of_its_plan(spark):
    """The joined rows an item stay the same at a thousand times the counts."""
    from pyspark.sql import functions as F

    rnd = random.Random(9)
    shape = {a: 1 + int(40 * rnd.random() ** 3) for a in rnd.sample(range(1, 513), 120)}

    def joined(times):
        h = {a: n * times for a, n in shape.items()}
        plan = packing.plan(dict(h), 512)
        parts = spark.createDataFrame([("m", *p) for p in plan], "container string, length int, first bigint, after bigint, base bigint, each bigint")
        salts = {a: min(packing.SALT, n) for a, n in h.items()}
        offsets = spark.createDataFrame([("m", a, s, n * s // salts[a]) for a, n in h.items() for s in range(salts[a])], "container string, length int, salt int, offset bigint")
        got = packing.ranges(offsets, parts)
        end = F.coalesce("high", F.create_map(*[F.lit(x) for kv in h.items() for x in kv])[F.col("length")])
        per = got.withColumn("n", end - F.col("low")).groupBy("length", "salt").agg(F.sum("n").alias("n"), F.count("*").alias("parts")).agg(F.sum(F.col("n") * F.col("parts")), F.sum("n")).first()
        assert per[1] == sum(h.values())
        check = got.join(parts.select("container", "length", "first", "after"), ["container", "length", "first"])
        assert check.count() == got.count() and check.where("low < first or coalesce(high, low + 1) > after").count() == 0
        return per[0] / per[1]

    assert joined(1000) <= max(3, joined(1) + 2)


def test_invariants_notice_what_is_wrong(spark, counts):
    d, s = docs(spark, some(60)), sizes(spark)
    counted = tokens.with_token_counts(d.select("doc_id", "text"))
    packed = packing.pack(d, s)
    good = {r.container: tuple(r)[2:] for r in packing.broken(packed, counted, s).collect()}
    assert good == {"s": (0, 0, 0), "m": (0, 0, 0)}
    bad = packed.where("piece > 0 or container = 's'").withColumn("container_no", packed.container_no % 2)
    found = {r.container: tuple(r)[2:] for r in packing.broken(bad, counted, s).collect()}
    assert found["s"][0] == 2 and found["m"][1] > 0


def targets(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "source string, target_share double, max_repeats int, h string")


def test_shares_are_met(spark, counts):
    rnd = random.Random(3)
    rows = [(k, "w " * rnd.randrange(5, 60), rnd.choice(["a"] * 6 + ["b"] * 3 + ["c"])) for k in range(3000)]
    t = targets(spark, [("a", 0.5, 1), ("b", 0.2, 2), ("c", 0.2, 3), ("gone", 0.1, 9), (None, 0.1, 1)])
    chosen, report = mixing.mix(docs(spark, rows), t)
    chosen, report = chosen.collect(), {r.source: r for r in report.collect()}
    assert len(chosen) == len({r.doc_id for r in chosen})
    limit = {"a": 1, "b": 2, "c": 3}
    tokens_of = {i: counts(x) for i, x, _ in rows}
    used = dict.fromkeys(limit, 0)
    for r in chosen:
        assert 1 <= r.repeats <= limit[r.source] and r.n_tokens == tokens_of[r.doc_id]
        used[r.source] += r.repeats * r.n_tokens
    for s, share in (("a", 0.5), ("b", 0.2), ("c", 0.2)):
        assert abs(report[s].reached_share - share / 0.9) < 0.002 and report[s].tokens == used[s]
        assert abs(used[s] - report[s].quota) <= 60
    assert report["gone"].tokens == 0 and report["gone"].reached_share == 0
    full = sum(n for i, n in tokens_of.items() if rows[i][2] == "c") * 3
    assert any(report[s].quota == limit[s] * report[s].available for s in limit) and report["c"].quota <= full


def test_budget_scarce_source_falls_short(spark):
    rows = [(k, "w " * 20, "a" if k % 10 else "b") for k in range(500)]
    report = {r.source: r for r in mixing.mix(docs(spark, rows), targets(spark, [("a", 0.5, 1), ("b", 0.5, 2)]), budget=6000)[1].collect()}
    assert report["b"].tokens == report["b"].available * 2 and abs(report["a"].tokens - 3000) <= 21


def test_mix_edges(spark):
    t = targets(spark, [("a", 0.5, None), ("b", None, 2), ("A ", 0.1, 1)])
    rows = [(1, None, "a"), (2, "", "a"), (3, "one", None), (4, "two", "zz"), (5, "three", " A"), (5, "three", " A"), (6, "four", "b")]
    chosen, report = mixing.mix(docs(spark, rows), t)
    assert {(r.doc_id, r.repeats) for r in chosen.collect()} == {(5, 1)}
    assert {r.source for r in report.collect()} == {"a", "b"}
    for d, tt in ((docs(spark, []), t), (docs(spark, rows), t.limit(0))):
        assert mixing.mix(d, tt)[0].count() == 0
