"""Report queries: quality now, trends, drivers, sensor issues, pipeline health, replay, shifts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaycast.functions.columns import epoch_hour, hour_from_epoch, shift_of
from assaycast.operators.calendar import HOUR
from assaycast.operators.features import lab_visible, visible_at
from assaycast.operators.health import unhealthy, with_confidence
from assaycast.operators.metrics import (
    global_importance,
    latest,
    rolling_mae,
    top_drivers,
)


def with_actuals(pred: DataFrame, lab: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Predictions with the lab value of their target hour, null while it is unknown."""
    actual = lab.select(*keys, F.col(HOUR).alias("target_hour"), F.col(value).alias("actual"))
    return pred.join(actual, [*keys, "target_hour"], "left")


def quality_now(
    pred: DataFrame, lab: DataFrame, confidence: DataFrame, limit: DataFrame, keys: Sequence[str], value: str, delay: int
) -> DataFrame:
    """Latest predicted hour of each plant: band, last known lab value, off-spec, confidence."""
    newest = latest(pred.where(F.col("horizon_h") == 0), keys, HOUR)
    lab_now = lab_visible(newest.select(*keys, HOUR), lab, keys, value, delay)
    out = with_confidence(newest, confidence, [*keys, HOUR]).join(lab_now, [*keys, HOUR], "left")
    return out.withColumn("pred_off_spec", F.col("predicted") > limit.scalar())


def trends(
    pred: DataFrame, lab: DataFrame, base: DataFrame, limit: DataFrame, keys: Sequence[str], value: str,
    first_day: str | None = None, last_day: str | None = None, shift: str | None = None, shift_start: int = 6,
) -> DataFrame:
    """Predicted, actual and persistence per target hour, with date (inclusive) and shift filters."""
    rows = pred.where(F.col("horizon_h") == 0)
    if first_day is not None:
        rows = rows.where(F.col("target_hour") >= F.lit(first_day).cast("date").cast("timestamp_ntz"))
    if last_day is not None:
        rows = rows.where(F.col("target_hour") < F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp_ntz"))
    if shift is not None:
        rows = rows.where(shift_of("target_hour", shift_start) == shift)
    naive = base.where(F.col("horizon_h") == 0).select(
        *keys, "target_hour", F.col("predicted").alias("persistence")
    )
    out = with_actuals(rows, lab, keys, value).join(naive, [*keys, "target_hour"], "left")
    return out.select(
        *keys, "target_hour", "predicted", "actual", "persistence",
        (F.col("actual") > limit.scalar()).alias("is_off_spec"),
        shift_of("target_hour", shift_start).alias("shift"),
    )


def drivers(contrib: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Global importance, and the top three per hour."""
    return global_importance(contrib), top_drivers(contrib, [*keys, HOUR])


def reagent_view(process: DataFrame, lab: DataFrame, keys: Sequence[str], value: str, reagents: Sequence[str]) -> DataFrame:
    """Hourly reagent means against the lab value of the hour."""
    return process.select(*keys, HOUR, *reagents).join(
        lab.where(F.col(value).isNotNull()).select(*keys, HOUR, value), [*keys, HOUR]
    )


def current_issues(health: DataFrame) -> DataFrame:
    """Flagged sensor hours, newest first."""
    return health.where(unhealthy()).orderBy(F.col(HOUR).desc(), "sensor")


def pipeline_health(runs: DataFrame, dq: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Last run of each stage, and the pass rate of each rule."""
    last = latest(runs, ["stage"], "finished_at")
    rate = dq.groupBy("rule_id").agg(
        F.avg(F.col("passed").cast("double")).alias("pass_rate"), F.sum("rows_failed").alias("rows_failed")
    )
    return last, rate


def model_health(pred_actual: DataFrame, keys: Sequence[str], hours: int = 168) -> DataFrame:
    return rolling_mae(pred_actual, keys, hours, hour="target_hour")


def replay_as_of(
    pred: DataFrame, lab: DataFrame, keys: Sequence[str], value: str, hour: str, delay: int
) -> DataFrame:
    """What was known at an hour: predictions made up to it, lab values up to h-L."""
    available: Column = hour_from_epoch(epoch_hour(HOUR) + delay)
    known_lab = visible_at(lab, available, hour)
    known_pred = visible_at(pred.where(F.col("horizon_h") == 0), HOUR, hour)
    return with_actuals(known_pred, known_lab, keys, value)


def shift_comparison(lab: DataFrame, value: str, by: Sequence[str] = (), start: int = 6) -> DataFrame:
    """Off-spec rate and mean quality per shift."""
    n, bad = F.count(F.lit(1)), F.count_if("is_off_spec")
    total = F.sum(F.col(value).cast("decimal(28,10)"))
    return lab.groupBy(*by, shift_of(HOUR, start).alias("shift")).agg(
        n.alias("n_hours"),
        bad.alias("off_spec_hours"),
        (bad / n).alias("off_spec_rate"),
        (total.cast("double") / F.count(value)).alias("mean_value"),
    )


def scale_report(runs: DataFrame) -> DataFrame:
    """Total and slowest-stage time per number of plants, from the run ledger."""
    seconds = F.unix_micros("finished_at") / 1e6 - F.unix_micros("started_at") / 1e6
    return runs.withColumn("_s", seconds).groupBy("scale").agg(
        F.sum("_s").alias("seconds"), F.max("_s").alias("slowest_stage"), F.sum("rows_out").alias("rows_out")
    )
