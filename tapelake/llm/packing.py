"""Texts packed into containers of fixed capacity, planned on the histogram of their lengths.

The histogram of lengths (at most one bin a token of capacity) is all the driver sees. Shallow
combinations of lengths that fill a window below the capacity are enumerated, non-negative least
squares finds how often to repeat each so that together they use up the histogram, the counts are
rounded down to what is there, and the rest is packed greedily, again on the histogram, with as
many repeats of each greedy combination as its lengths allow. The plan says which ranks of a
length go to which containers; documents get their rank within their length by salted counting,
so a length that a third of all documents share is spread over `SALT` groups. Each group of ranks
is cut at the plan's borders beforehand, so an item meets only the parts of the plan that fall
into its own group: a plan of S parts for a length costs S / `SALT` + 1 rows an item at most,
however many documents there are.

A text longer than the capacity is cut into full containers and one remainder, which is packed
like any other item; no other text is split. Null texts and texts without tokens take no place
and do not appear. Repeated rows are packed one by one. An empty table gives no containers.
Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .tokens import VOCABULARY, with_token_counts

SALT = 256
#: Combinations may leave this share of the capacity unused.
WINDOW = 1 / 64
#: Combinations enumerated at most. It bounds the plan and the least squares, not the items: what no combination covers is packed greedily, and a greater number only leaves less to that.
COMBINATIONS = 20_000


def combinations(lengths: np.ndarray, counts: np.ndarray, capacity: int, window: float = WINDOW, most: int = COMBINATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, multiplicities), each (patterns, 3): up to three distinct lengths, the first repeated, that fill [capacity - window, capacity]."""
    least = capacity - max(1, int(capacity * window))
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    near = np.maximum.accumulate(np.where(present, np.arange(capacity + 1), 0))  # greatest length not above
    per = max(4, int((most / max(1, len(lengths))) ** 0.5) + 1)
    common = lengths[np.argsort(-counts, kind="stable")][: per * per]
    ls, ms = [], []
    for a in lengths:
        top = capacity // a
        for m in sorted({1, 2, 3, top // 2, max(1, top - 1), top} - {0}):
            if m > top:
                continue
            rest = capacity - m * a
            if rest <= capacity - least:
                ls.append((a, 0, 0)), ms.append((m, 0, 0))
                continue
            b = near[rest]
            if b and rest - b <= capacity - least:
                ls.append((a, b, 0)), ms.append((m, 1, 0))
            for b in common[: per]:
                left = rest - b
                if left > 0 and (c := near[left]) and left - c <= capacity - least:
                    ls.append((a, b, c)), ms.append((m, 1, 1))
    if not ls:
        return np.zeros((0, 3), int), np.zeros((0, 3), int)
    return np.array(ls), np.array(ms)


def nnls(columns: np.ndarray, weights: np.ndarray, target: np.ndarray, steps: int = 300) -> np.ndarray:
    """x >= 0 that brings sum of x * weights at columns near `target` in squares: accelerated projected gradients on a sparse matrix."""
    x = np.zeros(len(columns))
    if not len(x):
        return x
    size = len(target)
    apply = lambda v: np.bincount(columns.ravel(), (weights * v[:, None]).ravel(), size)
    back = lambda r: (r[columns] * weights).sum(1)
    v = np.random.default_rng(0).random(len(x))
    for _ in range(20):
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= norm
    y, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(apply(y) - target) / (1.05 * norm))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def greedy(left: dict[int, int], capacity: int):
    """(multiset, copies) of combinations that use up a histogram: the longest first, each time the greatest length that still fits."""
    lengths = sorted(k for k, v in left.items() if v > 0)
    while lengths:
        room, used = capacity, {}
        while room > 0 and (i := bisect_right(lengths, room)):
            i -= 1
            while i >= 0 and left[lengths[i]] <= used.get(lengths[i], 0):
                i -= 1
            if i < 0:
                break
            a = lengths[i]
            take = min(room // a, left[a] - used.get(a, 0))
            used[a] = used.get(a, 0) + take
            room -= take * a
        copies = min(left[a] // m for a, m in used.items())
        yield used, copies
        for a, m in used.items():
            left[a] -= m * copies
            if not left[a]:
                lengths.remove(a)


def plan(histogram: dict[int, int], capacity: int, window: float = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first container, items of this length a container) that use up the histogram."""
    lengths = np.array(sorted(histogram), int)
    counts = np.array([histogram[a] for a in lengths], float)
    left = dict(histogram)
    used = dict.fromkeys(histogram, 0)
    out, base = [], 0

    def place(multiset: dict[int, int], copies: int) -> None:
        nonlocal base
        for a, m in multiset.items():
            out.append((int(a), used[a], used[a] + m * copies, base, m))
            used[a] += m * copies
        base += copies

    if len(lengths):
        ls, ms = combinations(lengths, counts, capacity, window)
        index = np.searchsorted(lengths, np.where(ls > 0, ls, lengths[0])) if len(ls) else ls
        x = nnls(index, ms.astype(float), counts)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            multiset: dict[int, int] = {}
            for a, m in zip(ls[j].tolist(), ms[j].tolist()):
                if m:
                    multiset[a] = multiset.get(a, 0) + m
            copies = min(int(x[j] + 0.5), *(left[a] // m for a, m in multiset.items()))
            if copies:
                place(multiset, copies)
                for a, m in multiset.items():
                    left[a] -= m * copies
        for multiset, copies in greedy(left, capacity):
            place(multiset, copies)
    return out


def pieces(counted: DataFrame, sizes: DataFrame) -> DataFrame:
    """container, capacity, doc_id, piece, start, length: whole texts, or full pieces and a remainder of texts beyond the capacity."""
    kinds = [(r["container"], r["capacity_tokens"]) for r in sizes.where("container is not null and capacity_tokens > 0").distinct().collect()]  # the kinds of containers are a fixed list
    every = F.array(*[F.struct(F.lit(n).alias("container"), F.lit(c).cast("bigint").alias("capacity")) for n, c in kinds])
    if not kinds:
        every = F.array().cast("array<struct<container:string,capacity:bigint>>")
    df = counted.where("n_tokens > 0").select("doc_id", "n_tokens", F.explode(every).alias("k")).select("doc_id", "n_tokens", "k.*")
    last = ((F.col("n_tokens") + F.col("capacity") - 1) / F.col("capacity")).cast("bigint") - 1
    df = df.select("container", "capacity", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    start = F.col("piece") * F.col("capacity")
    return df.select("container", "capacity", "doc_id", "piece", start.alias("start"), F.least(F.col("capacity"), F.col("n_tokens") - start).cast("int").alias("length"))


def pack(documents: DataFrame, sizes: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """container, container_no, doc_id, piece, start, length: where every token of every text goes."""
    spark = documents.sparkSession
    counted = materialize(with_token_counts(documents.select("doc_id", "text"), "text", vocabulary))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int")
    items = pieces(counted, sizes).withColumn("salt", salt)
    groups = items.groupBy("container", "capacity", "length", "salt").agg(F.count("*").alias("n"))
    groups = materialize(groups)
    histogram: dict = {}
    for r in groups.groupBy("container", "capacity", "length").agg(F.sum("n").alias("n")).collect():  # one row a length at most
        histogram.setdefault((r["container"], r["capacity"]), {})[r["length"]] = r["n"]
    rows = [(name, *p) for (name, capacity), h in sorted(histogram.items()) for p in plan(h, capacity)]
    schema = "container string, length int, first bigint, after bigint, base bigint, each bigint"
    parts = spark.createDataFrame(rows, schema)
    before = Window.partitionBy("container", "length").orderBy("salt")
    offsets = groups.select("container", "length", "salt", (F.sum("n").over(before) - F.col("n")).alias("offset"))
    places = materialize(ranges(offsets, parts))
    within = Window.partitionBy("container", "length", "salt").orderBy("doc_id", "piece")
    ranked = items.withColumn("at", F.row_number().over(within) - 1)
    placed = ranked.join(places, ["container", "length", "salt"])  # both sides are spread by these keys
    rank = F.col("offset") + F.col("at")
    placed = placed.where((rank >= F.col("low")) & (F.col("high").isNull() | (rank < F.col("high"))))
    number = F.col("base") + F.floor((rank - F.col("first")) / F.col("each"))
    return placed.select("container", number.cast("bigint").alias("container_no"), "doc_id", "piece", "start", "length")


def ranges(offsets: DataFrame, parts: DataFrame) -> DataFrame:
    """container, length, salt, offset, low, high, first, base, each: the ranks [low, high) of a length that lie in one group and in one part of the plan (high null: to the end)."""
    group = F.struct("salt", "offset")
    part = F.struct("first", "base", "each")
    none = lambda kind: F.lit(None).cast(kind)
    points = offsets.select("container", "length", F.col("offset").alias("low"), group.alias("group"), none("struct<first:bigint,base:bigint,each:bigint>").alias("part")).unionByName(
        parts.select("container", "length", F.col("first").alias("low"), none("struct<salt:int,offset:bigint>").alias("group"), part.alias("part"))
    )
    points = points.groupBy("container", "length", "low").agg(F.max("group").alias("group"), F.max("part").alias("part"))
    order = Window.partitionBy("container", "length").orderBy("low")  # a row a group and part of one length
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    held = points.select("container", "length", "low", F.lead("low").over(order).alias("high"), F.last("group", ignorenulls=True).over(running).alias("g"), F.last("part",
        ignorenulls=True).over(running).alias("p"))
    return held.select("container", "length", "g.salt", "g.offset", "low", "high", "p.first", "p.base", "p.each")


def broken(packed: DataFrame, counted: DataFrame, sizes: DataFrame) -> DataFrame:
    """container, documents, overfull, misplaced, split: what must hold of a packing, counted by kind of container.

    documents that have a place; containers beyond their capacity; documents whose pieces do not
    cover every token once; documents that are split although they fit.
    """
    caps = sizes.where("container is not null and capacity_tokens > 0").groupBy("container").agg(F.max("capacity_tokens").alias("capacity"))
    over = packed.groupBy("container", "container_no").agg(F.sum("length").alias("load")).join(caps,
        "container").groupBy("container").agg(F.count_if(F.col("load") > F.col("capacity")).alias("overfull"))
    pieces_of = packed.groupBy("container", "doc_id").agg(F.sum("length").alias("tokens"), F.max(F.col("start") + F.col("length")).alias("end"), F.countDistinct("start").alias("starts"),
        F.count("*").alias("n"))
    per = pieces_of.join(counted.where("n_tokens > 0").groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("longest")), "doc_id").join(caps, "container")
    wrong = (F.col("tokens") != F.col("n_tokens")) | (F.col("end") != F.col("longest"))
    by = per.groupBy("container").agg(F.count("*").alias("documents"), F.count_if(wrong).alias("misplaced"), F.count_if((F.col("starts") > 1) & (F.col("longest") <= F.col("capacity"))).alias("split"))
    return by.join(over, "container").select("container", "documents", "overfull", "misplaced", "split")


def usage(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """container, containers, items, tokens, unused_share by kind of container."""
    each = packed.groupBy("container", "container_no").agg(F.sum("length").alias("tokens"), F.count("*").alias("items"))
    by = each.groupBy("container").agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    caps = sizes.groupBy("container").agg(F.max("capacity_tokens").alias("capacity"))
    return by.join(caps, "container").select("container", "containers", "items", "tokens", "fullest", (1 - F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("unused_share"))
