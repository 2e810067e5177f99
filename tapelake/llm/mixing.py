"""Sources mixed to target shares of tokens, by hash thresholds instead of sorting.

Every listed source that has tokens gets the same scale: the largest total at which each can
meet its share within its allowed repeats. A source's quota is met by whole passes over all its
documents and one partial pass. The partial pass takes the documents whose hash lies below a
threshold, found on nested histograms: tokens are summed by source and hash bucket, the bucket in
which the quota is crossed is refined by the next bits of the hash, and only its documents, put
aside as a table of their own, are summed again. Documents are then filtered; nothing is sorted
and no source meets in one task.

Targets of absent sources can't be met; the others keep their proportions, and both the wanted
and the reached shares are reported. With `budget` the total is given, and a scarce source falls
short at its repeat limit. Null or unlisted sources, null texts and texts without tokens are not
used. A null or negative share counts as 0, a null repeat limit as 1. Repeated rows of a document
share its hash and go together. Of a source listed twice the greater share and limit hold. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import broadcast_if_small, materialize
from .tokens import VOCABULARY, with_token_counts

#: Bits of the hash that one histogram refines, and how many histograms are nested.
BITS, LEVELS = 10, 5
SEED = "mix"


def source_name(c):
    return F.lower(strip(c))


def _bucket(h, level: int):
    """Bits of level 0, 1, ... of a non-negative 60-bit hash."""
    return F.shiftright(h, BITS * (6 - 1 - level)).bitwiseAND((1 << BITS) - 1).cast("int")


def counted_documents(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, n_tokens, h of every usable document of a listed source."""
    wanted = targets.where("source is not null").select(source_name(F.col("source")).alias("source")).distinct()
    slim = documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").where("text is not null").join(broadcast_if_small(wanted), "source", "left_semi")
    h = F.xxhash64(F.lit(SEED), F.col("doc_id")).bitwiseAND((1 << 60) - 1)
    return with_token_counts(slim.select("doc_id", "source", h.alias("h"), "text"), "text", vocabulary).where("n_tokens > 0")


def quotas(totals: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, available, quota, passes (whole ones), rest (tokens of the partial pass)."""
    t = targets.where("source is not null").groupBy(source_name(F.col("source")).alias("source")).agg(
        F.coalesce(F.greatest(F.max("target_share"), F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.coalesce(F.greatest(F.max("max_repeats"), F.lit(0)),
            F.lit(1)).cast("bigint").alias("max_repeats")
    )
    t = t.join(totals, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    usable = (F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    w = Window.partitionBy(F.lit(0))  # one row a listed source
    t = t.withColumn("share", F.when(usable, F.col("target_share"))).withColumn("share", F.col("share") / F.sum("share").over(w))
    limit = F.col("available") * F.col("max_repeats")
    total = F.lit(float(budget)) if budget is not None else F.min(limit / F.col("share")).over(w)
    quota = F.when(F.col("share").isNull(), 0).otherwise(F.least(F.floor(total * F.col("share")), limit)).cast("bigint")  # least() skips nulls
    t = t.withColumn("quota", quota).withColumn("passes", F.when(F.col("available") > 0, F.floor(F.col("quota") / F.col("available"))).otherwise(0).cast("bigint"))
    return t.withColumn("rest", F.col("quota") - F.col("passes") * F.col("available"))


def thresholds(docs: DataFrame, quota: DataFrame, levels: int = LEVELS) -> DataFrame:
    """source, bound: documents with h < bound are in the partial pass; within one bucket of the last level of the quota."""
    edge = quota.where("rest > 0").select("source", F.col("rest").alias("left"), F.lit(0).cast("bigint").alias("low"))  # one row a listed source
    near = docs.select("source", "h", "n_tokens")
    for level in range(levels):
        width = F.lit(1 << (BITS * (6 - 1 - level))).cast("bigint")
        near = near.join(broadcast_if_small(edge.select("source", "left", "low")), "source").where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + width * (1 << BITS)))
        if level == 1:
            # One bucket in 2^BITS of each source: the levels below read only these documents.
            near = materialize(near)
        hist = near.groupBy("source", "low", "left", _bucket(F.col("h"), level).alias("b")).agg(F.sum("n_tokens").alias("n"))
        w = Window.partitionBy("source").orderBy("b")
        upto = hist.withColumn("before", F.sum("n").over(w) - F.col("n"))
        crossed = upto.where("before <= left and before + n > left")
        edge = materialize(crossed.select("source", (F.col("left") - F.col("before")).alias("left"), (F.col("low") + F.col("b") * width).alias("low"), width.alias("width"), "n"))
        near = near.select("source", "h", "n_tokens")
    # The last bucket goes in if that comes nearer to the quota.
    return edge.select("source", F.when(F.col("left") * 2 >= F.col("n"), F.col("low") + F.col("width")).otherwise(F.col("low")).alias("bound"))


def broken(selection: DataFrame, report: DataFrame, targets: DataFrame) -> DataFrame:
    """source, documents, too_often, twice, off: what must hold of a selection, by listed source.

    documents that could be used; selected ones beyond their repeats; selected ones that are there
    twice; whether the tokens miss the quota by more than half of the source's longest document.
    """
    limits = targets.where("source is not null").groupBy(source_name(F.col("source")).alias("source")).agg(F.coalesce(F.max("max_repeats"), F.lit(1)).alias("most"))
    chosen = selection.groupBy("source", "doc_id").agg(F.count("*").alias("rows"), F.max("repeats").alias("repeats")).join(limits, "source")
    by = chosen.groupBy("source").agg(F.count_if(F.col("repeats") > F.col("most")).alias("too_often"), F.count_if(F.col("rows") > 1).alias("twice"))
    off = F.coalesce(F.abs(F.col("tokens") - F.col("quota")) * 2 > F.col("longest"), F.lit(False))
    return report.join(by, "source", "left").select("source", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("too_often", F.lit(0)).alias("too_often"), F.coalesce("twice",
        F.lit(0)).alias("twice"), off.alias("off"))


def mix(documents: DataFrame, targets: DataFrame, budget: int | None = None, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, n_tokens, repeats of the selected documents; the report by source)."""
    docs = materialize(counted_documents(documents, targets, vocabulary))
    totals = docs.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("documents"), F.max("n_tokens").alias("longest"))
    quota = materialize(quotas(totals, targets, budget))
    bounds = thresholds(docs, quota)
    rule = quota.join(bounds, "source", "left").select("source", "passes", F.coalesce("bound", F.lit(0).cast("bigint")).alias("bound"))
    chosen = docs.join(broadcast_if_small(rule), "source").withColumn("repeats", F.col("passes") + F.when(F.col("h") < F.col("bound"), 1).otherwise(0)).where("repeats > 0")
    selection = chosen.select("doc_id", "source", "n_tokens", "repeats")
    used = selection.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"), F.count("*").alias("documents_used"))
    w = Window.partitionBy(F.lit(0))  # one row a listed source
    report = quota.join(used, "source", "left").select(
        "source", "documents", "longest", "target_share", F.col("share").alias("wanted_share"), "max_repeats", "available", "quota", F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents_used", F.lit(0)).alias("documents_used"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
    return selection, report.withColumn("reached_share", F.col("tokens") / F.sum("tokens").over(w))
