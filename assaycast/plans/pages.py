"""The report queries over the stored tables, one function per page."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaycast.config import KEY_SENSORS, Config
from assaycast.functions.columns import split_label
from assaycast.operators import features as ft
from assaycast.operators import metrics as mt
from assaycast.operators import quality as ql
from assaycast.operators.calendar import HOUR
from assaycast.operators.health import hour_confidence
from assaycast.operators.hourly import hourly_stats
from assaycast.operators.segments import chunk_of
from assaycast.plans import pipeline as pl
from assaycast.plans import reports as rp
from assaycast.sources.serving import write_metrics
from assaycast.sources.tables import Tables

KEYS, SILICA = pl.KEYS, pl.SILICA


def _lab(t: Tables) -> DataFrame:
    return ft.mask_interpolated(t.read("silver", "lab_results"), [SILICA])


def quality_now(spark: SparkSession, cfg: Config) -> DataFrame:
    t = Tables(spark, cfg)
    confidence = hour_confidence(t.read("silver", "sensor_health"), KEY_SENSORS, [*KEYS, HOUR])
    pred = pl.current_predictions(t).drop("confidence")
    return rp.quality_now(pred, _lab(t), confidence, pl.train_limit(t, cfg), KEYS, SILICA, cfg.ml.lab_delay_hours)


def trends(
    spark: SparkSession, cfg: Config, first_day: str | None = None, last_day: str | None = None, shift: str | None = None
) -> DataFrame:
    t = Tables(spark, cfg)
    lab = _lab(t)
    base = ft.persistence(lab, KEYS, SILICA, cfg.ml.lab_delay_hours, [0])
    return rp.trends(
        pl.current_predictions(t), lab, base, pl.train_limit(t, cfg), KEYS, SILICA,
        first_day, last_day, shift, cfg.ml.shift_starts_hour,
    )


def drivers(spark: SparkSession, cfg: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Global importance, top three per hour, reagents against silica."""
    t = Tables(spark, cfg)
    tops = pl.current_predictions(t).where("horizon_h = 0")
    process = t.read("gold", "fact_process_hourly")
    view = rp.reagent_view(process, _lab(t), KEYS, SILICA, ["starch_flow_mean", "amina_flow_mean"])
    return (
        t.read("gold", "feature_importance").orderBy(F.col("importance").desc()),
        tops.select(*KEYS, HOUR, "top_driver_1", "top_driver_2", "top_driver_3"),
        view,
    )


def sensor_issues(spark: SparkSession, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Flags per sensor and day, and the flagged hours, newest first."""
    health = Tables(spark, cfg).read("silver", "sensor_health")
    return mt.health_heatmap(health), rp.current_issues(health)


def pipeline_health(spark: SparkSession, cfg: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Last run per stage, pass rate per rule, rolling seven-day error."""
    t = Tables(spark, cfg)
    last, rate = rp.pipeline_health(t.read("gold", "fact_pipeline_runs"), t.read("gold", "fact_dq_results"))
    nowcast = pl.predictions_with_truth(t, cfg).where("horizon_h = 0")
    return last, rate, rp.model_health(nowcast, KEYS)


def data_freshness(spark: SparkSession, cfg: Config) -> DataFrame:
    """Latest hour, its age in hours and the rows of each stored layer of readings."""
    t = Tables(spark, cfg)
    lines = None
    for layer, name in (("silver", "process_readings"), ("gold", "fact_process_hourly"), ("gold", "fact_predictions")):
        df = t.read(layer, name)
        rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        line = ql.freshness_hours(df, HOUR, F.current_timestamp()).select(
            F.lit(name).alias("table_name"), "latest_hour", "age_hours", rows.alias("n_rows")
        )
        lines = line if lines is None else lines.unionByName(line)
    return lines


def replay_as_of(spark: SparkSession, cfg: Config, hour: str) -> DataFrame:
    t = Tables(spark, cfg)
    return rp.replay_as_of(pl.current_predictions(t), _lab(t), KEYS, SILICA, hour, cfg.ml.lab_delay_hours)


def shift_comparison(spark: SparkSession, cfg: Config) -> DataFrame:
    lab = Tables(spark, cfg).read("gold", "fact_lab_quality").where(~F.col("lab_is_interpolated"))
    return rp.shift_comparison(lab, SILICA, (), cfg.ml.shift_starts_hour)


def monitor(spark: SparkSession, cfg: Config) -> DataFrame:
    """Latest rolling error, validation error, worst drift of the top features, and the trigger."""
    t = Tables(spark, cfg)
    truth = pl.predictions_with_truth(t, cfg).where("horizon_h = 0")
    rolling = rp.model_health(truth, KEYS)
    # the last error of each plant, and of these the worst
    last = rolling.groupBy(*KEYS).agg(F.max_by("rolling_mae", "target_hour").alias("m"))
    now = last.agg(F.max("m").alias("m"))
    known = truth.where(split_label("target_hour", cfg.ml.split) == "val")
    reference = known.agg(F.avg(F.abs(F.col("predicted") - F.col("actual"))).alias("m"))
    worst = pl.drift(spark, cfg).agg(F.max("psi").alias("p"))
    line = now.select(
        F.col("m").alias("rolling_mae"), reference.scalar().alias("reference_mae"), worst.scalar().alias("worst_psi")
    )
    due = (F.col("rolling_mae") > cfg.ml.retrain_mae_ratio * F.col("reference_mae")) | (
        F.col("worst_psi") > cfg.ml.retrain_psi
    )
    return line.withColumn("retrain_needed", F.coalesce(due, F.lit(False)))


def scale_test(spark: SparkSession, cfg: Config, plants: tuple[int, ...] = (1, 10, 50)) -> DataFrame:
    """Run time of the hourly stage on real plus synthetic plants; written to the scale report.

    The replicas live in their own table and in ``dim_plant`` as synthetic, so no model sees them.
    """
    t = Tables(spark, cfg)
    sensors = cfg.features.process_sensors
    readings = t.read("silver", "process_readings").drop("month")
    lines = []
    for n in plants:
        many = ft.replicate_plants(readings, n - 1, pl.PLANT, sensors, ["_source_file", "_row_number"]) if n > 1 else (
            readings.withColumn("is_synthetic", F.lit(False))
        )
        dim = many.select(pl.PLANT, "is_synthetic").distinct()
        named = dim.withColumn("name", F.concat(F.lit("plant-"), F.col(pl.PLANT).cast("string")))
        t.upsert(named.where("is_synthetic").select(pl.PLANT, "name", "is_synthetic"), "gold", "dim_plant", [pl.PLANT])
        start = time.time()
        stats = hourly_stats(
            many, [pl.PLANT, HOUR], sensors, ["_source_file", "_row_number"],
            [F.col("_source_file"), chunk_of("_row_number", cfg.sizes.chunk_rows)], copies="copies",
        )
        counted = pl.Counter(stats)
        t.overwrite(counted.df, "gold", "scale_process_hourly")
        lines.append((n, float(time.time() - start), counted.rows))
    out = spark.createDataFrame(lines, "plants int, seconds double, rows_out long")
    write_metrics(out, os.path.join(cfg.paths.warehouse_root or cfg.paths.gold or "", "reports", "scale"))
    return out
