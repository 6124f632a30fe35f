"""File replay as a stream: hourly statistics, duplicates, idempotent sink, late labs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from assaycast.sources.tables import Tables


def replay_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int = 1,
    glob: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream, some files per trigger."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def event_time(c: Column | str) -> Column:
    """A watermark needs a zoned timestamp; plant time is naive, read as UTC."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def stream_hourly(
    sdf: DataFrame, keys: Sequence[str], ts: str, value: str, delay: str = "1 hour", scale: int = 10
) -> DataFrame:
    """Tumbling one-hour statistics; an hour is emitted once the watermark has passed it.

    The mean is exact for values of up to ``scale`` decimals.
    """
    timed = sdf.withColumn(ts, event_time(ts)).withWatermark(ts, delay)
    out = timed.groupBy(F.window(ts, "1 hour").alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col(value).cast(f"decimal({18 + scale},{scale})")).alias("_s"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        F.stddev_samp(value).alias("value_std"),
    )
    mean = (F.col("_s").cast("double") / F.col("row_count")).alias("value_mean")
    hour = F.col("_w.start").cast("timestamp_ntz").alias("hour_ts")
    return out.select(*keys, hour, "row_count", mean, "value_min", "value_max", "value_std")


def stream_dedup(sdf: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeats of the keys that arrive within the watermark; older state is released."""
    return sdf.withColumn(ts, event_time(ts)).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_join_labs(
    pred: DataFrame, lab: DataFrame, keys: Sequence[str], ts: str, value: str, delay: str = "1 hour"
) -> DataFrame:
    """Hourly predictions meet the lab value of the same hour, whichever comes later.

    Both sides are reduced to one row per key and hour before the join, so a key never multiplies;
    the hour windows bound the state through the watermarks.
    """

    def by_hour(sdf: DataFrame, name: str) -> DataFrame:
        timed = sdf.withColumn(ts, event_time(ts)).withWatermark(ts, delay)
        return timed.groupBy(F.window(ts, "1 hour"), *keys).agg(F.max(value).alias(name))

    joined = by_hour(pred, "predicted").join(by_hour(lab, "actual"), ["window", *keys])
    return joined.select(*keys, F.col("window.start").cast("timestamp_ntz").alias("hour_ts"), "predicted", "actual")


def upsert_batch(
    tables: Tables, layer: str, name: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """Sink function: a batch that is delivered twice leaves the table as after the first time.

    With ``partition_by`` a batch rewrites only the partitions it touches.
    """

    def sink(batch: DataFrame, _batch_id: int) -> None:
        tables.upsert(batch, layer, name, keys, partition_by)

    return sink


def run_to_end(sdf: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process all files present and stop."""
    query = (
        sdf.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
