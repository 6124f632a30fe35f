"""Mixing sources to target sizes by hash-threshold histograms.

Every document has a fixed 60-bit hash. The sizes are summed by source and by the leading hash bits; the running
sums show the one bucket in which a source's budget ends, and only that bucket is summed again by its next
bits, until the bucket is a single hash. Documents below the threshold are taken: a filter, without sorting
documents. Whole epochs come first, so a document is taken floor(target / source size) times, and once
more below the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaycast.llm.text import n_words
from assaycast.sources.tables import cut_lineage

HASH_BITS, LEVELS = 60, (10, 20, 30)
WEIGHTS = (3, 1, 2)


def doc_hash(doc_id: str) -> Column:
    """The first 15 hex digits of the MD5 of the id as text (null: empty)."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. Targets sum up to ``share`` of all sizes and stop at
    ``cap`` times their source's size. In order of cap over weight the capped sources are a prefix: the first source
    whose cap the even share of the rest does not pass ends it. Works on the sources only, never on documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_i") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("_i", F.row_number().over(order)).withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(cap))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_i")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(share)
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    s = s.withColumn("_level", level)
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("_i"), F.col("_level").alias("level")))
    s = s.withColumn("_at", F.min(fits).over(everything))
    target = F.coalesce(F.least(F.col("_cap"), F.col("_at.level") * F.col("_w")), F.col("_cap"))
    return s.select("source", "source_size", target.alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, threshold``: documents with a smaller hash are taken; docs: ``source, h, size``, budgets: ``source, budget``.

    The sum below the threshold is the largest one within the budget, or the next one if that is nearer.
    """
    state, done = None, 0
    for bits in LEVELS:
        shift = HASH_BITS - done - bits
        bucket = F.shiftright("h", shift).alias("bucket")
        if state is None:
            rows = docs.select("source", bucket, "size")
        else:
            s = state.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"))
            inside = F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("h", shift + bits) == F.col("_b"))
            rows = docs.join(s, inside).select("source", bucket, "size")
        run = Window.partitionBy("source").orderBy("bucket")
        hist = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(run))
        left = (budgets if state is None else state).select(F.col("source").alias("_s"), "budget")
        over = hist.join(left, F.col("source").eqNullSafe(F.col("_s"))).where(F.col("upto") > F.col("budget"))
        first = over.groupBy("source").agg(F.min(F.struct("bucket", "n", "upto", "budget")).alias("b"))
        budget = F.col("b.budget") - (F.col("b.upto") - F.col("b.n"))
        state = cut_lineage(first.select("source", "b.bucket", "b.n", budget.alias("budget")), "mix-boundary")
        done += bits
    nearer = F.col("n") - F.col("budget") < F.col("budget")
    return state.select("source", (F.col("bucket") + F.when(nearer, 1).otherwise(0)).alias("threshold"))


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, share: float = 1.5, cap: float = 2.0,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row; ``taken`` words are whole repeats of the document.

    Null text and texts without words have size 0 and are taken 0 words; a null source is a source. Rows with
    the same id share their hash and are taken alike. An empty table gives no rows. The hash depends on the id
    alone, so reruns and any partitioning agree. Documents are read once; their sizes are a stored table.
    """
    sizes = cut_lineage(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), doc_hash(doc_id).alias("h"), n_words(text).alias("size")),
        "mix-sizes",
    )
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(per, weights, share, cap)
    size = F.greatest(F.col("source_size"), F.lit(1))
    goal = goal.withColumn("epochs", F.floor(F.col("target") / size)).withColumn("budget", F.col("target") - F.col("epochs") * size)
    goal = cut_lineage(goal, "mix-targets")
    cut = thresholds(sizes, goal).withColumnRenamed("source", "_s")
    plan = goal.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("source", "_s")
    out = sizes.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    times = F.col("epochs") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))
