"""Connected components of a link table by alternating star steps, without any part of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaycast.sources.tables import cut_lineage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least node seen: with ``large`` those above a node, else those below it and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    met = both.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node of each component, for all nodes of ``links`` (``a, b``) but the roots themselves.

    Each round writes a table. The links end as stars, when a round changes nothing.
    """
    state = cut_lineage(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    mark = None
    while True:
        state = cut_lineage(_stars(_stars(state, True), False), "links")
        # count and sum of hashes tell whether the set of links changed
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
