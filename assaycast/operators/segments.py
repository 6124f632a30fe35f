"""Numbering and windows over groups of any size.

A plain window puts each whole group in one task, and one plant, sensor or hour may hold a third of
all rows. Here a group is first cut by a coarser form of its own order (``chunk``), numbered inside
the cuts, and shifted by the sizes of the cuts before. Frames of n rows then run on runs of fixed
length, each run with copies of the rows its frames reach into. Results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_of(row_number: str, rows: int) -> Column:
    """Cut of at most ``rows`` rows, for a column that is unique within its source."""
    return F.floor(F.col(row_number) / F.lit(rows))


def cut(df: DataFrame, chunk: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"_chunk{i}" for i in range(len(chunk))]
    return df.withColumns(dict(zip(names, chunk))), names


def with_ordinals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Sequence[Column]
) -> DataFrame:
    """Add ``ordinal`` and ``from_end`` (both from 1) of each row in its group.

    ``chunk`` must not decrease along ``order``. The keys and the order must hold no nulls.
    """
    keys = list(keys)
    df, names = cut(df, chunk)
    sizes = df.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*keys).orderBy(*names)
    before = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        *keys,
        *names,
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    local = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order))
    return (
        df.withColumn("_local", local)
        .join(offsets, [*keys, *names])
        .withColumn("ordinal", F.col("_local") + F.col("_before"))
        .withColumn("from_end", F.col("_total") - F.col("ordinal") + 1)
        .drop(*names, "_local", "_before", "_total")
    )


def with_segments(df: DataFrame, position: str, size: int, before: int, after: int = 0) -> DataFrame:
    """Cut each group into runs of ``size`` positions, with border rows copied to the neighbour.

    Window over the keys plus ``_segment``, then keep the rows with ``_home``. A run holds at most
    ``size + before + after`` positions.
    """
    if max(before, after) > size:
        raise ValueError("a run must be at least as long as the frame")
    segment = F.floor(F.col(position) / F.lit(size))
    inside = F.pmod(F.col(position), F.lit(size))
    places = [F.struct(segment.alias("s"), F.lit(True).alias("home"))]
    if before:
        places.append(
            F.when(inside >= size - before, F.struct((segment + 1).alias("s"), F.lit(False).alias("home")))
        )
    if after:
        places.append(F.when(inside < after, F.struct((segment - 1).alias("s"), F.lit(False).alias("home"))))
    spread = df.withColumn("_place", F.explode(F.array_compact(F.array(*places))))
    return spread.withColumns({"_segment": F.col("_place.s"), "_home": F.col("_place.home")}).drop("_place")


def home_rows(df: DataFrame) -> DataFrame:
    return df.where("_home").drop("_segment", "_home")
