"""Queries over the driver tables.

The tables hold no plant data, so ``events`` is read as readings: plant from the user, sensor from the
event type, file order from the event id (unique, in time order). ``purchase`` is the lab assay,
``signup`` the feed quality, the other types are process sensors. The code ``k`` of ``props`` marks
faulty text fields.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaycast.config import Config, Split
from assaycast.functions import columns as fc
from assaycast.functions.stats import exact_percentiles
from assaycast.operators import calendar as cal
from assaycast.operators import features as ft
from assaycast.operators import health as hl
from assaycast.operators import hourly as hr
from assaycast.operators import metrics as mt
from assaycast.operators import models as md
from assaycast.operators import quality as ql
from assaycast.operators.segments import chunk_of
from assaycast.plans import reports as rp
from assaycast.session import scratch_dir
from assaycast.sources import raw
from assaycast.sources.tables import Tables, cut_lineage, merge_rows
from assaycast.streaming import replay as st

CHUNK = 500_000
HOUR = cal.HOUR
SPLIT = Split("2024-01-01", "2024-01-18", "2024-01-19", "2024-01-23", "2024-01-24", "2024-01-31")
HORIZONS = [0, 1, 2, 3, 4]
DELAY = 1
PROCESS = ["click", "view", "error"]
BATCH_RULES = ["DQ02", "DQ03", "DQ05"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def plant_of(user: str):
    """Forty users make a plant, so that the number of plants grows with the data."""
    return F.floor(F.col(user) / 40)


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        fc.trunc_hour("ts").alias(HOUR),
        plant_of("user_id").alias("plant"),
        F.col("event_type").alias("sensor"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def order_and_chunk() -> tuple[list[str], list]:
    return ["event_id"], [chunk_of("event_id", CHUNK)]


# ---- parsing and checks -------------------------------------------------------------------


def decimal_comma_parse(spark, sf):
    text = (
        F.when(F.col("k") == 13, "n/a")
        .when(F.col("k") == 14, "")
        .otherwise(F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")))
    )
    rows = readings(spark, sf).select("event_id", text.alias("text"))
    parsed = rows.withColumn("parsed", fc.parse_decimal("text"))
    return parsed.withColumn("is_bad", ql.dq02([F.col("text")], [F.col("parsed")]))


def raw_texts(spark, sf):
    day = F.date_format(HOUR, "yyyy-MM-dd HH:mm:ss")
    return readings(spark, sf).select(
        "event_id",
        "plant",
        "sensor",
        F.when(F.col("k") == 57, "2017-13-40 01:00:00").otherwise(day).alias("date_text"),
        F.when(F.col("k") == 13, "n/a")
        .otherwise(F.concat(F.floor("value").cast("string"), F.lit(",0")))
        .alias("value_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("batch"),
    )


def disposed(spark, sf):
    first = ql.dedup_keep_first(raw_texts(spark, sf), ["plant", "sensor", "date_text", "value_text"], ["event_id"])
    parsed = first.withColumns({HOUR: fc.parse_hour("date_text"), "value": fc.parse_decimal("value_text")})
    rules = {
        "DQ02": ql.dq02([F.col("value_text")], [F.col("value")]),
        "DQ03": ql.dq03(HOUR, "2024-01-01", "2024-01-29"),
        "DQ05": ql.dq05({"value": (0, 200)}),
    }
    return ql.with_disposition(parsed, rules)


def schema_cast_dispositions(spark, sf):
    return disposed(spark, sf).select(
        "event_id", "plant", "sensor", HOUR, "value", "dq_status", "rule_id",
        F.concat_ws(",", "failed_rules").alias("failed_rules"), "copies",
    )


def dedup_keep_first(spark, sf):
    rows = readings(spark, sf).select("event_id", HOUR, "sensor", F.floor("value").alias("level"))
    return ql.dedup_keep_first(rows, [HOUR, "sensor", "level"], ["event_id"])


def reconcile_layers(spark, sf):
    return ql.reconcile(readings(spark, sf), disposed(spark, sf))


def dq_results(spark, sf):
    return ql.dq_results(disposed(spark, sf), BATCH_RULES, "batch")


def dq_pass_rate(spark, sf):
    runs = spark.createDataFrame([("s", None)], "stage string, finished_at timestamp")
    return rp.pipeline_health(runs, dq_results(spark, sf))[1]


def fact_key_orphans(spark, sf):
    parts = table(spark, sf, "part").where(F.col("p_size") <= 25)
    return ql.orphans(table(spark, sf, "lineitem"), parts, "l_partkey", "p_partkey")


def unique_keys(spark, sf):
    return ql.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- hourly statistics --------------------------------------------------------------------


def hourly(spark, sf, aggregates):
    order, chunk = order_and_chunk()
    return hr.hourly_stats(
        readings(spark, sf), ["plant", "sensor", HOUR], ["value"], order, chunk, tail_rows=5, aggregates=aggregates
    )


def process_hourly(spark, sf):
    out = hourly(spark, sf, ["mean", "std", "min", "max", "last_15min_mean", "slope"])
    return out.select(
        "plant", "sensor", HOUR, "row_count", F.round("value_mean", 8).alias("value_mean"),
        F.round("value_std", 6).alias("value_std"), "value_min", "value_max",
        F.round("value_last_15min_mean", 8).alias("value_last_mean"), F.round("value_slope", 6).alias("value_slope"),
    )


def last_window_mean_slope(spark, sf):
    order, chunk = order_and_chunk()
    out = hr.hourly_stats(
        readings(spark, sf), ["plant", HOUR], ["value"], order, chunk, tail_rows=3, aggregates=["last_15min_mean", "slope"]
    )
    return out.select(
        "plant", HOUR, "row_count", F.round("value_last_15min_mean", 8).alias("last_mean"),
        F.round("value_slope", 6).alias("slope"),
    )


def completeness(spark, sf):
    per_hour = readings(spark, sf).groupBy(HOUR).agg(F.count(F.lit(1)).alias("row_count"))
    return hr.completeness(per_hour, 14, 80).withColumn("completeness_pct", F.round("completeness_pct", 8))


def lab_plant(spark, sf):
    """Hourly assay per plant; an hour with several values counts as interpolated."""
    lab = readings(spark, sf).where("sensor = 'purchase'").withColumnRenamed("value", "silica")
    return hr.lab_hourly(lab, ["plant", HOUR], ["silica"], 1, scale=2)


def lab_hourly_interpolated(spark, sf):
    return lab_plant(spark, sf)


def feed_hourly(spark, sf):
    feed = readings(spark, sf).where("sensor = 'signup'").withColumnRenamed("value", "feed")
    return hr.feed_hourly(feed, ["plant", HOUR], ["feed"], 1, scale=2)


def wide_hourly(spark, sf):
    """Hourly mean of each process sensor, one row per plant and hour."""
    means = [
        fc.exact_mean(F.when(F.col("sensor") == s, F.col("value")), 2).alias(f"{s}_mean") for s in PROCESS
    ]
    return readings(spark, sf).groupBy("plant", HOUR).agg(F.count(F.lit(1)).alias("row_count"), *means)


# ---- health -------------------------------------------------------------------------------

LIMITS = [("click", 0.0, 200.0), ("view", 0.0, 250.0), ("error", None, 150.0), ("signup", 1.0, None), ("purchase", None, None)]


def sensor_limits(spark):
    return spark.createDataFrame(LIMITS, "name string, valid_min double, valid_max double")


def flags(spark, sf):
    order, chunk = order_and_chunk()
    rows = readings(spark, sf).withColumn("level", F.floor(F.col("value") / 50).cast("double"))
    return hl.row_flags(rows, ["sensor"], ["level"], order, chunk, flat_rows=6, which=["flat"])


def flatline(spark, sf):
    return flags(spark, sf).where("level_flat").select("event_id", "sensor", HOUR)


def spike(spark, sf):
    order, chunk = order_and_chunk()
    out = hl.row_flags(readings(spark, sf), ["sensor"], ["value"], order, chunk, which=["spike"])
    return out.where("value_spike").select("event_id", "sensor", HOUR, "value")


def out_of_range(spark, sf):
    long = readings(spark, sf).select("event_id", "sensor", "value")
    return hl.out_of_range(long, sensor_limits(spark)).select("event_id", "sensor", "value")


def health_rows(spark, sf):
    order, chunk = order_and_chunk()
    rows = readings(spark, sf).withColumn("level", F.floor(F.col("value") / 50).cast("double"))
    out = hl.row_flags(
        rows.withColumnRenamed("sensor", "series"), ["plant", "series"], ["value"], order, chunk, flat_rows=6,
        flat_values=["level"],
    )
    out = out.withColumnRenamed("level_flat", "value_flat")
    hourly = hl.hourly_health(out, ["plant", "series", HOUR], ["value"], {"value": (0, 200)})
    return hourly.drop("sensor").withColumnRenamed("series", "sensor")


def sensor_health(spark, sf):
    return health_rows(spark, sf)


def current_issues(spark, sf):
    return rp.current_issues(health_rows(spark, sf)).select(
        "plant", HOUR, "sensor", "is_flatline", "is_out_of_range", "has_spike"
    )


def health_heatmap(spark, sf):
    return mt.health_heatmap(health_rows(spark, sf))


def hour_confidence(spark, sf):
    return hl.hour_confidence(health_rows(spark, sf), ["click", "view"], ["plant", HOUR])


def control_chart(spark, sf):
    lab = cut_lineage(lab_plant(spark, sf).select("plant", HOUR, "silica"), "lab")
    chart = hl.control_chart(lab, lab.where(fc.split_label(HOUR, SPLIT) == "train"), "silica", 2.0)
    return chart.select(
        "plant", HOUR, "silica", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "is_breach"
    )


# ---- calendar -----------------------------------------------------------------------------


def gap_islands(spark, sf):
    return cal.gap_islands(lab_plant(spark, sf), ["plant"])


def hour_spine(spark, sf):
    return cal.on_spine(lab_plant(spark, sf).select("plant", HOUR, "silica"), ["plant"])


def dim_time_shift(spark, sf):
    return cal.dim_time(readings(spark, sf))


# ---- tables -------------------------------------------------------------------------------


def counts_by_hour(rows):
    return rows.groupBy("plant", HOUR).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


def upsert_idempotent(spark, sf):
    cfg = Config()
    cfg.paths.gold = scratch_dir(spark, "upsert")
    t = Tables(spark, cfg)
    rows = readings(spark, sf)
    day = F.to_date(HOUR).alias("day")
    old = counts_by_hour(rows.where(F.col("ts") < "2024-01-20")).select("*", day)
    new = counts_by_hour(rows.where((F.col("ts") >= "2024-01-15 12:00:00") & (F.col("value") > 20))).select("*", day)
    t.upsert(old, "gold", "hours", ["plant", HOUR], ["day"])
    t.upsert(new, "gold", "hours", ["plant", HOUR], ["day"])
    t.upsert(new, "gold", "hours", ["plant", HOUR], ["day"])
    return t.read("gold", "hours").drop("day")


def compare_builds(spark, sf):
    rows = readings(spark, sf)
    return ql.compare_builds(counts_by_hour(rows), counts_by_hour(rows.where("value <= 200")), ["plant", HOUR])


def merged_snapshot(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("amount"))
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("amount")
    )
    return merge_rows(customers, spent, ["c_custkey"])


def raw_load_dense(spark, sf):
    """Events written as text files with decimal commas, loaded again with row numbers."""
    path = os.path.join(scratch_dir(spark, "raw"), "csv")
    text = readings(spark, sf).select(
        F.date_format(HOUR, "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias("Value"),
    )
    text.write.option("header", True).option("quoteAll", True).csv(path)
    rows = raw.bronze_rows(spark, path, ["date", "Value"])
    per_file = rows.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"), F.max("_row_number").alias("top"), F.min("_row_number").alias("low"),
        F.sum(fc.parse_decimal("Value").cast("decimal(18,2)")).alias("total"),
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.sum("top").alias("sum_of_last_numbers"), F.min("low").alias("first_number"),
        F.sum("total").cast("double").alias("total"),
    )


# ---- features -----------------------------------------------------------------------------


def masked_lab(spark, sf):
    return ft.mask_interpolated(lab_plant(spark, sf), ["silica"])


def stored_lab(spark, sf):
    """The masked lab table, written once: reports read it several times, the readings only once."""
    return cut_lineage(masked_lab(spark, sf), "lab")


def sensor_lags(spark, sf):
    base = wide_hourly(spark, sf).select("plant", HOUR, "click_mean", "view_mean")
    return ft.lagged(base, ["plant"], ["click_mean", "view_mean"], [1, 2, 3])


def lab_lags(spark, sf):
    return ft.lab_lags(masked_lab(spark, sf), ["plant"], "silica", DELAY, [1, 2, 3])


def horizon_targets(spark, sf):
    feat = wide_hourly(spark, sf).select("plant", HOUR, "click_mean")
    return ft.with_targets(feat, masked_lab(spark, sf), ["plant"], "silica", HORIZONS)


def persist_pairs(lab):
    """Persistence forecasts beside their actual value."""
    pred = ft.persistence(lab, ["plant"], "silica", DELAY, HORIZONS)
    return rp.with_actuals(pred, lab, ["plant"], "silica")


def persistence_metrics(spark, sf):
    out = mt.error_metrics(persist_pairs(stored_lab(spark, sf)), ["horizon_h"])
    return out.select("horizon_h", "n", F.round("mae", 8).alias("mae"), F.round("rmse", 8).alias("rmse"))


def naive_pairs(lab):
    """A second forecast, the mean of the three lab lags, beside persistence and actual."""
    lags = ft.lab_lags(lab, ["plant"], "silica", DELAY, [1, 2, 3])
    mean = (F.col("lab_lag1") + F.col("lab_lag2") + F.col("lab_lag3")) / 3
    pred = ft.at_horizons(lags.select("plant", HOUR, F.col("lab_lag1").alias("persistence"), mean.alias("predicted")), [0])
    return rp.with_actuals(pred, lab, ["plant"], "silica")


def persistence_skill(spark, sf):
    out = mt.skill(naive_pairs(stored_lab(spark, sf)))
    return out.select("n", *[F.round(c, 8).alias(c) for c in ("mae", "rmse", "persistence_mae", "skill")])


def lab_asof(spark, sf):
    spine = cal.hour_spine(readings(spark, sf), ["plant"])
    return ft.lab_visible(spine, stored_lab(spark, sf), ["plant"], "silica", DELAY)


def small_config() -> Config:
    cfg = Config()
    cfg.ml.split = SPLIT
    cfg.ml.lab_delay_hours = DELAY
    return cfg


def features(spark, sf):
    feed = feed_hourly(spark, sf)
    return ft.assemble_features(
        wide_hourly(spark, sf), feed, lab_plant(spark, sf), small_config(), ["plant"],
        [f"{s}_mean" for s in PROCESS], "silica", ["feed"],
    )


def assembled_features(spark, sf):
    return features(spark, sf)


def walk_forward_folds(spark, sf):
    folds = ft.expanding_folds("2024-01-10", 3, 4)
    rows = ft.assign_folds(lab_plant(spark, sf), folds)
    return rows.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.max(HOUR).alias("last_hour"))


def time_split(spark, sf):
    rows = readings(spark, sf).withColumn("split", fc.split_label("ts", SPLIT))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def training_hours(spark, sf):
    per_hour = hr.completeness(wide_hourly(spark, sf), 4, 80).where("is_trainable")
    return ft.training_hours(lab_plant(spark, sf), per_hour, ["plant"])


def plant_replicas(spark, sf):
    rows = readings(spark, sf).select("event_id", "plant", "sensor", HOUR, "value")
    out = ft.replicate_plants(rows, 3, "plant", ["value"], ["event_id"], 24, 0.05, 7)
    return out.withColumn("value", F.round("value", 8))


def replica_hourly(spark, sf):
    """The hourly plan on real and synthetic plants together."""
    rows = readings(spark, sf).select("event_id", "plant", "sensor", HOUR, "value")
    out = ft.replicate_plants(rows, 2, "plant", ["value"], ["event_id"], 24, 0.05, 7)
    return out.groupBy("plant", "is_synthetic", HOUR).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg("value"), 8).alias("value_mean")
    )


# ---- measures -----------------------------------------------------------------------------


def limit(lab):
    return mt.threshold(lab.where(fc.split_label(HOUR, SPLIT) == "train"), "silica", 75)


def off_spec_threshold(spark, sf):
    return limit(stored_lab(spark, sf)).select(F.round("threshold", 9).alias("threshold"))


def sensor_quantiles(spark, sf):
    shares = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    out = exact_percentiles(readings(spark, sf), "value", shares, ["sensor"])
    return out.select("sensor", *[F.round(c, 9).alias(c) for c in shares])


def lab_flagged(spark, sf):
    lab = stored_lab(spark, sf)
    return mt.with_off_spec(lab.where("silica IS NOT NULL"), limit(lab), "silica")


def off_spec_by_shift(spark, sf):
    return mt.off_spec_by_shift(lab_flagged(spark, sf), ["plant"])


def shift_comparison(spark, sf):
    return rp.shift_comparison(lab_flagged(spark, sf), "silica")


def off_spec_pr(spark, sf):
    lab = stored_lab(spark, sf)
    pairs = persist_pairs(lab).where("horizon_h = 0")
    cut = limit(lab)
    flagged = mt.with_off_spec(mt.with_off_spec(pairs, cut, "predicted", "pred_off_spec"), cut, "actual")
    return mt.off_spec_pr(flagged)


def coverage(spark, sf):
    pairs = persist_pairs(stored_lab(spark, sf)).where("horizon_h = 0 AND predicted IS NOT NULL AND actual IS NOT NULL")
    label = cut_lineage(pairs.withColumn("split", fc.split_label("target_hour", SPLIT)), "pairs")
    band = md.conformal(label.where("split = 'val'"), label.where("split = 'test'"))
    return mt.coverage(band)


def psi(spark, sf):
    rows = readings(spark, sf).withColumn("split", fc.split_label("ts", SPLIT)).select("sensor", "value", "split")
    out = mt.psi(rows.where("split = 'train'"), rows.where("split = 'test'"), "sensor", "value")
    return out.select("sensor", F.round("psi", 8).alias("psi"))


def rolling_mae(spark, sf):
    pairs = persist_pairs(stored_lab(spark, sf)).where("horizon_h = 0")
    out = mt.rolling_mae(pairs, ["plant"], 168, "target_hour")
    return out.withColumn("rolling_mae", F.round("rolling_mae", 8))


def iron_corr(spark, sf):
    both = lab_plant(spark, sf).join(feed_hourly(spark, sf), ["plant", HOUR])
    out = mt.correlation(both, "silica", "feed", ["plant"])
    return out.withColumn("correlation", F.round("correlation", 8))


def profile_rows_per_hour(spark, sf):
    return mt.profile_rows_per_hour(readings(spark, sf), ["plant"])


def profile_distinct(spark, sf):
    rows = readings(spark, sf).withColumn("level", F.floor("value"))
    return mt.profile_distinct(rows, ["sensor"], "level")


WEIGHTS = {"click_mean": 0.5, "view_mean": -0.25, "error_mean": 1.5}
MEANS = {"click_mean": 50.0, "view_mean": 40.0, "error_mean": 60.0}


def contributions(spark, sf):
    return md.linear_contributions(wide_hourly(spark, sf), ["plant", HOUR], WEIGHTS, MEANS)


def drivers_topk(spark, sf):
    return mt.top_drivers(contributions(spark, sf), ["plant", HOUR], 3)


def global_importance(spark, sf):
    return mt.global_importance(contributions(spark, sf)).withColumn("importance", F.round("importance", 8))


# ---- reports ------------------------------------------------------------------------------


def trends(spark, sf):
    lab = stored_lab(spark, sf)
    pairs = naive_pairs(lab).drop("actual", "persistence")
    base = ft.persistence(lab, ["plant"], "silica", DELAY, [0])
    out = rp.trends(pairs, lab, base, limit(lab), ["plant"], "silica", "2024-01-05", "2024-01-25", "B")
    return out.withColumn("predicted", F.round("predicted", 8))


def replay_as_of(spark, sf):
    lab = stored_lab(spark, sf)
    pred = ft.persistence(lab, ["plant"], "silica", DELAY, [0])
    return rp.replay_as_of(pred, lab, ["plant"], "silica", "2024-01-20 10:00:00", DELAY).select(
        "plant", HOUR, "target_hour", "predicted", "actual"
    )


def quality_now(spark, sf):
    lab = stored_lab(spark, sf)
    pred = ft.persistence(lab, ["plant"], "silica", DELAY, [0])
    conf = hl.hour_confidence(health_rows(spark, sf), ["click", "view"], ["plant", HOUR])
    return rp.quality_now(pred, lab, conf, limit(lab), ["plant"], "silica", DELAY).select(
        "plant", HOUR, "predicted", "lab_value", "lab_hour", "confidence", "pred_off_spec"
    )


def reagent_view(spark, sf):
    return rp.reagent_view(wide_hourly(spark, sf), masked_lab(spark, sf), ["plant"], "silica", ["click_mean"])


# ---- models -------------------------------------------------------------------------------


def model_rows(spark, sf, horizons=(0,)):
    rows = ft.with_targets(features(spark, sf), masked_lab(spark, sf), ["plant"], "silica", list(horizons))
    return rows.withColumn("split", fc.split_label("target_hour", SPLIT))


def stored_model_rows(spark, sf, horizons=(0,)):
    """Features written once: fitting reads them many times."""
    path = os.path.join(scratch_dir(spark, "features"), "rows")
    model_rows(spark, sf, horizons).write.parquet(path)
    return spark.read.parquet(path)


def model_inputs(rows):
    return ft.feature_columns(rows, ["pct_iron_concentrate"], ["plant"])


def tested(spark, sf, fit):
    rows = stored_model_rows(spark, sf)
    fitted = fit(rows.where("split = 'train'"), model_inputs(rows))
    return md.score(fitted, rows.where("split = 'test'")).select("plant", HOUR, "predicted", F.col("target").alias("actual"))


def ridge(spark, sf):
    return tested(spark, sf, lambda d, c: md.fit_ridge(d, c, 1.0))


def gbt(spark, sf):
    return tested(spark, sf, lambda d, c: md.fit_gbt(d, c, 8, 3))


def forest(spark, sf):
    return tested(spark, sf, lambda d, c: md.fit_forest(d, c, 15, 4))


def forest_quantiles(spark, sf):
    rows = stored_model_rows(spark, sf)
    train = rows.where("split = 'train'")
    fq = md.fit_forest_quantiles(train, md.fit_forest(train, model_inputs(rows), 15, 4), 20)
    test = rows.where("split = 'test'")
    return md.predict_quantiles(fq, test, ["plant", HOUR], {"p10": 0.1, "p50": 0.5, "p90": 0.9})


def model_comparison(spark, sf):
    rows = stored_model_rows(spark, sf)
    train, val, cols = rows.where("split = 'train'"), rows.where("split = 'val'"), model_inputs(rows)
    out = None
    for name, fit in {
        "ridge": lambda: md.fit_ridge(train, cols), "gbt": lambda: md.fit_gbt(train, cols, 8, 3),
        "forest": lambda: md.fit_forest(train, cols, 15, 4),
    }.items():
        part = md.score(fit(), val).select(
            F.lit(name).alias("model"), "predicted", F.col("lab_lag1").alias("persistence"), F.col("target").alias("actual")
        )
        out = part if out is None else out.unionByName(part)
    return mt.compare_models(out)


def walk_forward_cv(spark, sf):
    rows = stored_model_rows(spark, sf)
    folds = ft.expanding_folds("2024-01-12", 2, 6)
    folded = ft.assign_folds(rows.where("split != 'test'"), folds, "target_hour")
    grid = {f"ridge-{r:g}": (lambda d, c, r=r: md.fit_ridge(d, c, r)) for r in (0.1, 10.0)}
    return md.walk_forward_cv(folded, model_inputs(rows), grid, [f[0] for f in folds])


def ablation(spark, sf):
    rows = stored_model_rows(spark, sf)
    leak = lab_plant(spark, sf).select("plant", F.col(HOUR).alias("target_hour"), F.col("silica").alias("assay_twin"))
    with_leak = rows.join(leak, ["plant", "target_hour"], "left")
    return md.ablation(with_leak, model_inputs(rows), ["assay_twin"], lambda d, c: md.fit_ridge(d, c, 0.1), ["plant", HOUR])


def horizon_curve(spark, sf):
    rows = stored_model_rows(spark, sf, HORIZONS)
    out = md.horizon_study(rows, model_inputs(rows), lambda d, c: md.fit_ridge(d, c, 1.0), HORIZONS)
    named = out.withColumns({"persistence": F.col("lab_lag1"), "actual": F.col("target")})
    return mt.horizon_curve(named)


def shapley_drivers(spark, sf):
    rows = stored_model_rows(spark, sf)
    fitted = md.fit_forest(rows.where("split = 'train'"), model_inputs(rows), 10, 4)
    groups = {s: [c for c in fitted.columns if c.startswith(s)] for s in [*PROCESS, "lab", "feed"]}
    parts = md.group_contributions(fitted, rows.where("split = 'test'"), ["plant", HOUR], groups)
    return mt.top_drivers(parts, ["plant", HOUR], 3)


def conformal_interval(spark, sf):
    rows = stored_model_rows(spark, sf)
    fitted = md.fit_ridge(rows.where("split = 'train'"), model_inputs(rows))
    scored = md.score(fitted, rows).withColumnRenamed("target", "actual")
    return mt.coverage(md.conformal(scored.where("split = 'val'"), scored.where("split = 'test'")))


# ---- streams ------------------------------------------------------------------------------


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return st.replay_stream(spark, sf, schema, glob="events.parquet").select(
        "event_id", "ts", plant_of("user_id").alias("plant"), F.col("event_type").alias("sensor"), "value"
    )


def stream_table(spark, name):
    cfg = Config()
    root = scratch_dir(spark, name)
    cfg.paths.gold = root
    return Tables(spark, cfg), os.path.join(root, "_progress")


def replay_stream_hourly(spark, sf):
    t, progress = stream_table(spark, "stream")
    stats = st.stream_hourly(event_stream(spark, sf), ["sensor"], "ts", "value")
    st.run_to_end(stats, st.upsert_batch(t, "gold", "hours", ["sensor", HOUR]), progress)
    return t.read("gold", "hours").withColumn("value_std", F.round("value_std", 6))


def stream_dedup(spark, sf):
    """Duplicates of (hour, sensor, level): which of them survives a stream is free, so keys are returned."""
    t, progress = stream_table(spark, "dedup")
    rows = event_stream(spark, sf).select(
        "ts", "sensor", fc.trunc_hour("ts").alias(HOUR), F.floor("value").alias("level")
    )
    kept = st.stream_dedup(rows, [HOUR, "sensor", "level"], "ts", "2 hours").select(HOUR, "sensor", "level")
    st.run_to_end(kept, st.upsert_batch(t, "gold", "rows", [HOUR, "sensor", "level"]), progress)
    return t.read("gold", "rows")


def stream_join_labs(spark, sf):
    """Hourly maximum of 'error' as the prediction, of 'purchase' as its lab value."""
    t, progress = stream_table(spark, "labs")
    both = event_stream(spark, sf)
    joined = st.stream_join_labs(
        both.where("sensor = 'error'"), both.where("sensor = 'purchase'"), ["plant"], "ts", "value"
    )
    st.run_to_end(joined, st.upsert_batch(t, "gold", "pairs", ["plant", HOUR]), progress)
    return t.read("gold", "pairs")


# order of the survey: checks, statistics, health, calendar, tables, features, measures, reports, models, streams
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        decimal_comma_parse, schema_cast_dispositions, dedup_keep_first, reconcile_layers, dq_results, dq_pass_rate,
        fact_key_orphans, unique_keys,
        process_hourly, last_window_mean_slope, completeness, lab_hourly_interpolated, feed_hourly,
        flatline, spike, out_of_range, sensor_health, current_issues, health_heatmap, hour_confidence, control_chart,
        gap_islands, hour_spine, dim_time_shift,
        upsert_idempotent, compare_builds, merged_snapshot, raw_load_dense,
        sensor_lags, lab_lags, horizon_targets, persistence_metrics, persistence_skill, lab_asof, assembled_features,
        walk_forward_folds, time_split, training_hours, plant_replicas, replica_hourly,
        off_spec_threshold, sensor_quantiles, off_spec_by_shift, shift_comparison, off_spec_pr, coverage, psi,
        rolling_mae, iron_corr, profile_rows_per_hour, profile_distinct, drivers_topk, global_importance,
        trends, replay_as_of, quality_now, reagent_view,
        ridge, gbt, forest, forest_quantiles, model_comparison, walk_forward_cv, ablation, horizon_curve,
        shapley_drivers, conformal_interval,
        replay_stream_hourly, stream_dedup, stream_join_labs,
    ]
}
