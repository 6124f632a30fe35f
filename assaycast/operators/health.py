"""Sensor health: flatline, spike, range, control chart, confidence of an hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaycast.operators.segments import home_rows, with_ordinals, with_segments


def row_flags(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    chunk: Sequence[Column],
    flat_rows: int = 30,
    flat_std: float = 1e-6,
    spike_rows: int = 90,
    spike_z: float = 4.0,
    segment_rows: int = 200_000,
    which: Sequence[str] = ("flat", "spike"),
    flat_values: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``<value>_flat`` and ``<value>_spike`` to every row.

    Flat: part of a run of ``flat_rows`` readings whose deviation is below ``flat_std``; all rows of
    the run are marked. Spike: more than ``spike_z`` deviations from the mean of the ``spike_rows``
    readings before it. ``flat_values`` names other columns for the flat test. Both frames run on one cut of each group, so a hot plant or sensor is split.
    """
    flat, spike = "flat" in which, "spike" in which
    before = max(spike_rows if spike else 0, flat_rows - 1 if flat else 0)
    after = flat_rows - 1 if flat else 0
    size = max(segment_rows, before, after)
    numbered = with_ordinals(df, keys, order, chunk).drop("from_end")
    group = [*keys, "_segment"]
    # one shuffle by run serves all windows below, those by block inside a run too
    out = with_segments(numbered, "ordinal", size, before, after).repartition(*group)

    if spike:
        out = with_frame_moments(out, group, "ordinal", values, spike_rows, "prior", current=False)
        hits = {}
        for v in values:
            m = F.col("prior")[v]
            # a frame of equal values has no deviation to compare with
            z = F.when(m["low"] < m["high"], F.try_divide(F.abs(F.col(v) - m["mean"]), m["sd"]))
            hits[f"{v}_spike"] = F.coalesce((m["n"] == spike_rows) & (z > spike_z), F.lit(False))
        out = out.withColumns(hits).drop("prior")
    if flat:
        still_values = list(flat_values or values)
        out = with_frame_moments(out, group, "ordinal", still_values, flat_rows, "recent", current=True)
        back = Window.partitionBy(*group).orderBy(F.desc("ordinal")).rowsBetween(Window.unboundedPreceding, 0)
        marks = {}
        for v in still_values:
            m = F.col("recent")[v]
            still = (m["n"] == flat_rows) & (m["sd"] < flat_std)
            # the nearest row, here or later, at which a flat run ends
            end = F.last(F.when(still, F.col("ordinal")), ignorenulls=True).over(back)
            marks[f"{v}_flat"] = F.coalesce(end - F.col("ordinal") < flat_rows, F.lit(False))
        out = out.withColumns(marks).drop("recent")
    return home_rows(out).drop("ordinal")


def with_frame_moments(
    df: DataFrame, group: Sequence[str], position: str, values: Sequence[str], rows: int, name: str, current: bool
) -> DataFrame:
    """Add ``name``: per value the count, mean, deviation, low and high of a frame of ``rows`` rows.

    The frame ends at the row (``current``) or just before it; positions have no holes. A sliding frame
    costs its length per row and value. Here positions are cut into blocks as long as the frame, and a
    frame is the tail of one block plus the head of the next: two running aggregates, a lag and a merge,
    whatever the length.
    """
    block, offset = F.floor(F.col(position) / F.lit(rows)), F.pmod(F.col(position), F.lit(rows))
    blocks = [*group, "_block"]
    heads = Window.partitionBy(*blocks).orderBy(position).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    tails = Window.partitionBy(*blocks).orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, 0)

    def moments(window) -> Column:
        return F.struct(
            *[
                F.struct(
                    F.count(v).over(window).alias("n"),
                    F.avg(v).over(window).alias("mean"),
                    F.var_pop(v).over(window).alias("var"),
                    F.min(v).over(window).alias("low"),
                    F.max(v).over(window).alias("high"),
                ).alias(v)
                for v in values
            ]
        )

    out = df.withColumn("_block", block).withColumn("_tail", moments(tails)).withColumn("_head", moments(heads))
    ago = rows - 1 if current else rows
    tail = F.lag("_tail", ago).over(Window.partitionBy(*group).orderBy(position))
    # with the current row, the last row of a block has its whole frame in the head
    out = out.withColumn("_tail", F.when(offset < rows - 1, tail) if current else tail)

    def merged(v: str) -> Column:
        a, b = F.col("_tail")[v], F.col("_head")[v]
        na, nb = F.coalesce(a["n"], F.lit(0)), F.coalesce(b["n"], F.lit(0))
        ma, mb = F.coalesce(a["mean"], b["mean"]), F.coalesce(b["mean"], a["mean"])
        n = na + nb
        spread = (
            na * F.coalesce(a["var"], F.lit(0.0))
            + nb * F.coalesce(b["var"], F.lit(0.0))
            + F.try_divide(na * nb, n) * (ma - mb) * (ma - mb)
        )
        return F.struct(
            n.alias("n"),
            F.try_divide(na * ma + nb * mb, n).alias("mean"),
            F.sqrt(F.try_divide(spread, n - 1)).alias("sd"),
            F.least(a["low"], b["low"]).alias("low"),
            F.greatest(a["high"], b["high"]).alias("high"),
        ).alias(v)

    return out.withColumn(name, F.struct(*[merged(v) for v in values])).drop("_block", "_tail", "_head")


def long_readings(df: DataFrame, keep: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide rows to one row per sensor."""
    return df.unpivot(list(keep), list(values), "sensor", "value")


def out_of_range(long: DataFrame, dim_sensor: DataFrame) -> DataFrame:
    """Readings outside the limits of their sensor. The dimension has one row per sensor (config)."""
    limits = F.broadcast(dim_sensor.select(F.col("name").alias("sensor"), "valid_min", "valid_max"))
    low = F.coalesce(F.col("value") < F.col("valid_min"), F.lit(False))
    high = F.coalesce(F.col("value") > F.col("valid_max"), F.lit(False))
    return long.join(limits, "sensor").where(low | high)


def hourly_health(flagged: DataFrame, keys: Sequence[str], sensors: Sequence[str], limits: dict) -> DataFrame:
    """Flags per sensor and hour from wide flagged rows; counts first, then one row per sensor."""
    counts = [F.count(F.lit(1)).alias("_rows")]
    for s in sensors:
        low, high = limits.get(s, (None, None))
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(s) < F.lit(float(low)))
        if high is not None:
            bad = bad | (F.col(s) > F.lit(float(high)))
        counts += [
            F.count_if(f"{s}_flat").alias(f"_flat_{s}"),
            F.count_if(f"{s}_spike").alias(f"_spike_{s}"),
            F.count_if(bad).alias(f"_range_{s}"),
        ]
    wide = flagged.groupBy(*keys).agg(*counts)
    lines = F.array(
        *[
            F.struct(
                F.lit(s).alias("sensor"),
                F.col("_rows").alias("row_count"),
                F.col(f"_flat_{s}").alias("flatline_rows"),
                F.col(f"_range_{s}").alias("out_of_range_rows"),
                F.col(f"_spike_{s}").alias("spike_rows"),
            )
            for s in sensors
        ]
    )
    long = wide.select(*keys, F.explode(lines).alias("h")).select(*keys, "h.*")
    return with_issue_flags(long)


def with_issue_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_flatline": F.col("flatline_rows") > 0,
            "is_out_of_range": F.col("out_of_range_rows") > 0,
            "has_spike": F.col("spike_rows") > 0,
        }
    )


def unhealthy() -> Column:
    return F.col("is_flatline") | F.col("is_out_of_range") | F.col("has_spike")


def control_limits(train: DataFrame, value: str, sigmas: float = 3.0) -> DataFrame:
    """Shewhart centre and limits, one row."""
    return train.agg(F.avg(value).alias("centre"), F.stddev_samp(value).alias("sd")).select(
        "centre",
        (F.col("centre") - sigmas * F.col("sd")).alias("lower"),
        (F.col("centre") + sigmas * F.col("sd")).alias("upper"),
    )


def control_chart(df: DataFrame, train: DataFrame, value: str, sigmas: float = 3.0) -> DataFrame:
    """Every hour against the limits of the training hours."""
    limits = control_limits(train, value, sigmas).select(F.struct("centre", "lower", "upper"))
    out = df.withColumn("_l", limits.scalar())
    return out.withColumns({c: F.col(f"_l.{c}") for c in ("centre", "lower", "upper")}).drop("_l").withColumn(
        "is_breach", (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))
    )


def hour_confidence(health: DataFrame, key_sensors: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per hour: how many key sensors are unhealthy."""
    key = F.col("sensor").isin(list(key_sensors))
    return health.groupBy(*keys).agg(F.count_if(key & unhealthy()).alias("bad_key_sensors"))


def with_confidence(pred: DataFrame, confidence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reduced confidence when a key sensor is unhealthy or the hour has no health row."""
    out = pred.join(confidence, list(keys), "left")
    reduced = F.coalesce(F.col("bad_key_sensors"), F.lit(1)) > 0
    return out.withColumn("confidence", F.when(reduced, "reduced").otherwise("normal")).drop("bad_key_sensors")
