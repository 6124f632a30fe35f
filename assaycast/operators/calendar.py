"""Hour spine, gaps, time dimension.

Groups here hold one row per hour of a plant: 8,760 a year, so a window per plant is bounded by the
date range that DQ03 enforces, whatever the number of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaycast.functions.columns import epoch_hour, hour_from_epoch, hour_key, shift_date, shift_of

HOUR = "hour_ts"


def hour_spine(df: DataFrame, keys: Sequence[str], start=None, end=None) -> DataFrame:
    """Every hour between the first and last of each group (or the given bounds)."""
    first = F.min(HOUR) if start is None else F.lit(start).cast("timestamp_ntz")
    last = F.max(HOUR) if end is None else F.lit(end).cast("timestamp_ntz")
    span = df.groupBy(*keys).agg(epoch_hour(first).alias("_a"), epoch_hour(last).alias("_b"))
    hours = F.explode(F.sequence("_a", "_b"))
    return span.select(*keys, hours.alias("_h")).select(*keys, hour_from_epoch(F.col("_h")).alias(HOUR))


def on_spine(df: DataFrame, keys: Sequence[str], start=None, end=None) -> DataFrame:
    """Hourly rows with the missing hours added as nulls."""
    spine = hour_spine(df, keys, start, end)
    return spine.join(df, [*keys, HOUR], "left")


def gap_islands(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of missing hours between observed ones."""
    hours = df.select(*keys, HOUR).distinct().withColumn("_h", epoch_hour(HOUR))
    following = F.lead("_h").over(Window.partitionBy(*keys).orderBy("_h"))
    found = hours.withColumn("_next", following).where(F.col("_next") - F.col("_h") > 1)
    return found.select(
        *keys,
        hour_from_epoch(F.col("_h") + 1).alias("gap_start"),
        hour_from_epoch(F.col("_next") - 1).alias("gap_end"),
        (F.col("_next") - F.col("_h") - 1).alias("missing_hours"),
    )


def dim_time(df: DataFrame, shift_start: int = 6) -> DataFrame:
    """One row per distinct hour."""
    return df.select(HOUR).distinct().select(
        hour_key(HOUR).alias("hour_key"),
        F.col(HOUR).alias("ts"),
        F.to_date(HOUR).alias("date"),
        F.hour(HOUR).alias("hour"),
        shift_of(HOUR, shift_start).alias("shift"),
        shift_date(HOUR, shift_start).alias("shift_date"),
        F.dayofweek(HOUR).alias("day_of_week"),
        F.weekofyear(HOUR).alias("week"),
        F.month(HOUR).alias("month"),
    )
