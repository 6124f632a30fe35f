from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaycast.functions import columns as fc
from assaycast.functions.stats import exact_percentiles
from assaycast.operators import calendar as cal
from assaycast.operators import features as ft
from assaycast.operators import health as hl
from assaycast.operators import hourly as hr
from assaycast.operators import metrics as mt
from assaycast.operators import quality as ql
from assaycast.operators.segments import chunk_of, with_ordinals

START = datetime(2017, 3, 1)


def hours(spark, rows, schema):
    """Rows whose second item is an hour number."""
    data = [(r[0], START + timedelta(hours=r[1]), *r[2:]) for r in rows]
    return spark.createDataFrame(data, schema)


def skewed(spark, n=700, seed=1):
    """Half of the rows in one group and one hour."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.5
        rows.append(("a" if hot else rng.choice("bcd"), 5 if hot else rng.randrange(4), i, round(rng.uniform(0, 9), 2) if rng.random() > 0.05 else None))
    rows.sort(key=lambda r: r[1])
    rows = [(k, h, i, v) for i, (k, h, _, v) in enumerate(rows)]
    return hours(spark, rows, "k string, hour_ts timestamp_ntz, rn long, v double")


@pytest.mark.parametrize("chunk", [7, 64, 10_000])
def test_ordinals_equal_plain_window(spark, chunk):
    df = skewed(spark)
    out = with_ordinals(df, ["k"], ["rn"], [chunk_of("rn", chunk)])
    w = Window.partitionBy("k")
    plain = df.select(
        "rn", F.row_number().over(w.orderBy("rn")).alias("ordinal"), F.row_number().over(w.orderBy(F.desc("rn"))).alias("from_end")
    )
    assert ql.same_rows(plain.select("rn", F.col("ordinal").cast("long"), F.col("from_end").cast("long")), out.select("rn", F.col("ordinal").cast("long"), F.col("from_end").cast("long")))


@pytest.mark.parametrize("chunk", [7, 50, 10_000])
def test_hourly_stats_equal_brute_force(spark, chunk):
    df = skewed(spark)
    out = hr.hourly_stats(df, ["k", "hour_ts"], ["v"], ["rn"], [chunk_of("rn", chunk)], tail_rows=9)
    got = out.toPandas().set_index(["k", "hour_ts"])
    for key, g in df.toPandas().sort_values("rn").groupby(["k", "hour_ts"]):
        row, v = got.loc[key], g["v"]
        x = pd.Series(np.arange(1, len(g) + 1), index=g.index)[v.notna()]
        assert row["row_count"] == len(g)
        assert row["v_mean"] == pytest.approx(v.mean())
        assert row["v_std"] == pytest.approx(v.std())
        assert (row["v_min"], row["v_max"]) == (v.min(), v.max())
        assert row["v_last_15min_mean"] == pytest.approx(v.tail(9).mean())
        assert row["v_slope"] == pytest.approx(np.polyfit(x, v.dropna(), 1)[0])


def test_slope_and_std_of_a_single_row_are_null(spark):
    df = hours(spark, [("a", 0, 1, 2.0)], "k string, hour_ts timestamp_ntz, rn long, v double")
    row = hr.hourly_stats(df, ["k", "hour_ts"], ["v"], ["rn"], [chunk_of("rn", 5)]).first()
    assert row["v_std"] is None and row["v_slope"] is None and row["v_mean"] == 2.0


@pytest.mark.parametrize("segment", [30, 10_000])
def test_flags_equal_plain_window(spark, segment):
    rng = random.Random(4)
    level, rows = 0.0, []
    for i in range(600):
        level = level if rng.random() < 0.85 else float(rng.randrange(5))
        rows.append((("a", "b")[rng.random() < 0.2], 0, i, level + (50 if rng.random() < 0.01 else 0)))
    df = hours(spark, rows, "k string, hour_ts timestamp_ntz, rn long, v double")
    out = hl.row_flags(df, ["k"], ["v"], ["rn"], [chunk_of("rn", 13)], 5, 1e-6, 20, 3.0, segment)
    w = Window.partitionBy("k").orderBy("rn")
    recent, prior = w.rowsBetween(-4, 0), w.rowsBetween(-20, -1)
    plain = df.withColumns({
        "end": (F.count("v").over(recent) == 5) & (F.stddev_samp("v").over(recent) < 1e-6),
        "v_spike": F.coalesce((F.count("v").over(prior) == 20) & (
            F.abs(F.col("v") - F.avg("v").over(prior)) / F.nullif(F.stddev_samp("v").over(prior), F.lit(0.0)) > 3.0), F.lit(False)),
    }).withColumn("v_flat", F.max("end").over(w.rowsBetween(0, 4)))
    assert plain.where("v_flat").count() > 20 and plain.where("v_spike").count() > 2
    assert ql.same_rows(plain.select("rn", "v_flat", "v_spike"), out.select("rn", "v_flat", "v_spike"))


@pytest.mark.parametrize("n,flat", [(29, 0), (30, 30)])
def test_flatline_needs_thirty_readings_across_hours(spark, n, flat):
    values = [float(i) for i in range(50)] + [7.0] * n + [float(i) for i in range(50)]
    df = hours(spark, [("a", i // 60, i, v) for i, v in enumerate(values)], "k string, hour_ts timestamp_ntz, rn long, v double")
    out = hl.row_flags(df, ["k"], ["v"], ["hour_ts", "rn"], [F.col("hour_ts"), chunk_of("rn", 100)])
    assert out.where("v_flat").count() == flat


@pytest.mark.parametrize("history,hit", [(89, 0), (90, 1)])
def test_spike_needs_ninety_prior_rows(spark, history, hit):
    values = [10.0 + 0.1 * (i % 2) for i in range(history)] + [50.0]
    df = hours(spark, [("a", 0, i, v) for i, v in enumerate(values)], "k string, hour_ts timestamp_ntz, rn long, v double")
    out = hl.row_flags(df, ["k"], ["v"], ["rn"], [chunk_of("rn", 100)])
    assert out.where("v_spike").count() == hit


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some.lists(some.integers(0, 40), min_size=1, max_size=80))
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.75, "e": 1.0}
    row = exact_percentiles(df, "v", shares).first()
    for name, q in shares.items():
        assert row[name] == pytest.approx(np.quantile(values, q))


def test_percentiles_of_many_values_per_key(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.sqrt(F.xxhash64("id") % 1_000_003 + 1_000_003).alias("v"))
    got = exact_percentiles(df, "v", {"a": 0.25, "b": 0.9}, ["k"], accuracy=200).toPandas().set_index("k")
    for k, g in df.toPandas().groupby("k"):
        assert got.loc[k, "a"] == pytest.approx(np.quantile(g["v"], 0.25), rel=1e-12)
        assert got.loc[k, "b"] == pytest.approx(np.quantile(g["v"], 0.9), rel=1e-12)


def test_parse_decimal(spark):
    texts = ["55,2", " 16,98 ", "-1", "1,5e2", "5x,2", "NaN", "Infinity", "1e999", "1d", "1.234,5", "", None, "+,5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(fc.parse_decimal("t"))
    assert [r[0] for r in df.collect()] == [55.2, 16.98, -1.0, 150.0] + [None] * 8 + [0.5]


def test_parse_hour(spark):
    texts = ["2017-03-10 01:00:00", "2017-03-10 01:37", "2017-13-40 01:00:00", "2017-03", "yesterday", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(fc.parse_hour("t"))
    hour = datetime(2017, 3, 10, 1)
    assert [r[0] for r in df.collect()] == [hour, hour, None, None, None, None]


def test_shifts(spark):
    times = ["05:59", "06:00", "13:59", "14:00", "21:59", "22:00", "00:00"]
    df = spark.createDataFrame([(datetime.fromisoformat(f"2017-03-10 {t}"),) for t in times], "t timestamp_ntz")
    rows = df.select(fc.shift_of("t"), fc.shift_date("t")).collect()
    assert "".join(r[0] for r in rows) == "CAABBCC"
    assert [r[1].day for r in rows] == [9, 10, 10, 10, 10, 10, 9]


@pytest.mark.parametrize("n,ok", [(143, False), (144, True)])
def test_completeness_limit(spark, n, ok):
    df = spark.createDataFrame([(n,)], "row_count long")
    assert hr.completeness(df, 180, 80).first()["is_trainable"] is ok


def test_contract(spark):
    ql.check_contract(["A", "b"], ["a", "B"])
    for bad in (["a"], ["a", "b", "c"], ["a", "b", "B"]):
        with pytest.raises(ql.CheckFailed):
            ql.check_contract(bad, ["a", "b"])


def test_duplicates_keep_lowest_row(spark):
    df = spark.createDataFrame([("f2", 1, "x", None), ("f1", 9, "x", None), ("f1", 3, "x", None), ("f1", 1, "y", 1)], "file string, rn long, a string, b int")
    rows = ql.dedup_keep_first(df, ["a", "b"], ["file", "rn"]).collect()
    assert {(r["a"], r["file"], r["rn"], r["copies"]) for r in rows} == {("x", "f1", 3, 3), ("y", "f1", 1, 1)}


def test_key_checks(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert ql.orphans(fact, dim, "k").collect() == [(2, 1)]
    with pytest.raises(ql.CheckFailed):
        ql.assert_unique(fact, ["k"], "DQ09")
    with pytest.raises(ql.CheckFailed):
        ql.assert_no_orphans(fact, dim, "k")
    ql.assert_unique(dim, ["k"], "DQ09")
    ql.assert_no_orphans(dim, fact, "k")


def test_write_guard(spark):
    df = spark.createDataFrame([(1, 5.0)], "k int, v double")
    contract = {"k": "int", "v": "double"}
    assert ql.write_guard(df, contract, {"positive": F.col("v") > 0}).count() == 1
    with pytest.raises(ql.CheckFailed):
        ql.write_guard(df, {"k": "int"})
    with pytest.raises(Exception, match="constraint small violated"):
        ql.write_guard(df, contract, {"small": F.col("v") < 1}).collect()


def test_reconciliation_failure(spark):
    bronze = spark.range(3)
    disposed = spark.createDataFrame([("ok", 1)], "dq_status string, copies long")
    with pytest.raises(ql.CheckFailed, match="DQ08"):
        ql.assert_reconciled(ql.reconcile(bronze, disposed))


def test_two_lab_values_flag_the_hour(spark):
    lab = hours(spark, [("p", 0, 1.0, 60.0), ("p", 0, 2.0, 60.0), ("p", 1, 3.0, 61.0), ("p", 1, 3.0, 61.0), ("p", 2, None, None)],
                "plant string, hour_ts timestamp_ntz, si double, fe double")
    rows = hr.lab_hourly(lab, ["plant", "hour_ts"], ["si", "fe"]).orderBy("hour_ts").collect()
    assert [(r["si"], r["fe"], r["lab_is_interpolated"]) for r in rows] == [(1.5, 60.0, True), (3.0, 61.0, False), (None, None, False)]
    masked = ft.mask_interpolated(hr.lab_hourly(lab, ["plant", "hour_ts"], ["si", "fe"]), ["si"])
    assert [r["si"] for r in masked.orderBy("hour_ts").collect()] == [None, 3.0, None]


def test_lags_look_at_hours_not_rows(spark):
    df = hours(spark, [("p", h, float(h)) for h in (1, 2, 5)], "plant string, hour_ts timestamp_ntz, v double")
    for block in (2, 1000):
        rows = ft.lagged(df, ["plant"], ["v"], [1, 2], block).orderBy("hour_ts").collect()
        assert [(r["v_lag1"], r["v_lag2"]) for r in rows] == [(None, None), (1.0, None), (None, None)]
    gap = cal.gap_islands(df, ["plant"]).collect()
    assert [(g["gap_start"].hour, g["gap_end"].hour, g["missing_hours"]) for g in gap] == [(3, 4, 2)]
    assert cal.on_spine(df, ["plant"]).count() == 5


def test_horizon_targets_and_lab_lags(spark):
    lab = hours(spark, [("p", h, 10.0 * h) for h in range(8)], "plant string, hour_ts timestamp_ntz, si double")
    lags = ft.lab_lags(lab, ["plant"], "si", 2, [1, 2])
    row = lags.where(F.hour("hour_ts") == 5).first()
    assert (row["lab_lag1"], row["lab_lag2"]) == (30.0, 20.0)
    t = ft.with_targets(lab.select("plant", "hour_ts"), lab, ["plant"], "si", [0, 3]).where(F.hour("hour_ts") == 2)
    assert {(r["horizon_h"], r["target"]) for r in t.collect()} == {(0, 20.0), (3, 50.0)}


@pytest.mark.parametrize("block", [2, 5, 1000])
def test_carry_forward(spark, block):
    values = [None, 1.0, None, None, None, None, None, 2.0, None, 3.0, None]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i long, v double")
    rows = ft.carry_forward(df, ["k"], ["v"], "i", block).orderBy("i").collect()
    assert [r["last_v"] for r in rows] == pd.Series(values).ffill().replace({np.nan: None}).tolist()


def test_lab_is_visible_only_after_its_delay(spark):
    spine = hours(spark, [("p", h) for h in range(6)], "plant string, hour_ts timestamp_ntz")
    lab = hours(spark, [("p", 1, 5.0), ("p", 3, None), ("p", 4, 6.0)], "plant string, hour_ts timestamp_ntz, si double")
    rows = ft.lab_visible(spine, lab, ["plant"], "si", 1).orderBy("hour_ts").collect()
    assert [r["lab_value"] for r in rows] == [None, None, 5.0, 5.0, 5.0, 6.0]


def test_leak_audit_catches_a_planted_leak(spark):
    process = hours(spark, [("p", h, float(h * h)) for h in range(12)], "plant string, hour_ts timestamp_ntz, v double")
    feed = hours(spark, [("p", h, 1.0 * h) for h in range(12)], "plant string, hour_ts timestamp_ntz, f double")
    lab = hours(spark, [("p", h, 2.0 * h) for h in range(12)], "plant string, hour_ts timestamp_ntz, si double")
    at = "2017-03-01 06:00:00"

    def honest(p, f, x):
        lags = ft.lab_lags(x, ["plant"], "si", 1, [1, 2])
        return ft.lagged(p, ["plant"], ["v"], [1, 2]).join(f, ["plant", "hour_ts"], "left").join(lags, ["plant", "hour_ts"], "left")

    def ahead(p, f, x):
        w = Window.partitionBy("plant").orderBy("hour_ts").rowsBetween(0, 1)
        return honest(p.withColumn("v", F.avg("v").over(w)), f, x)

    def same_hour_lab(p, f, x):
        return honest(p, f, x).join(x, ["plant", "hour_ts"], "left")

    assert ft.leak_audit(honest, process, feed, lab, at, 1) == []
    assert ft.leak_audit(ahead, process, feed, lab, at, 1) == ["features use process rows after the cut-off"]
    assert ft.leak_audit(same_hour_lab, process, feed, lab, at, 1) == ["features use lab rows after the cut-off"]
    with pytest.raises(ValueError):
        ft.feature_columns(process.withColumn("pct_iron_concentrate", F.lit(1.0)), ["pct_iron_concentrate"], ["plant"])


def test_folds_expand(spark):
    folds = ft.expanding_folds("2017-03-02", 2, 1)
    df = hours(spark, [("p", h) for h in range(96)], "plant string, hour_ts timestamp_ntz")
    out = {(r["fold"], r["role"]): r["count"] for r in ft.assign_folds(df, folds).groupBy("fold", "role").count().collect()}
    assert out == {(0, "train"): 24, (0, "val"): 24, (1, "train"): 48, (1, "val"): 24}


def test_measures(spark):
    df = spark.createDataFrame([("p", 1.0, 2.0, 2.0, 0.5, 1.5), ("p", 4.0, 2.0, 4.0, 3.0, 5.0)], "plant string, predicted double, persistence double, actual double, p10 double, p90 double")
    row = mt.skill(df).first()
    assert row["mae"] == 0.5 and row["persistence_mae"] == 1.0 and row["skill"] == 0.5
    assert mt.skill(df, pred="persistence").first()["skill"] == 0.0
    assert mt.coverage(df).first()["coverage"] == 0.5
    assert mt.coverage(df.where("false")).first()["coverage"] is None
    flags = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False), (None, True)], "pred_off_spec boolean, is_off_spec boolean")
    row = mt.off_spec_pr(flags).first()
    assert (row["tp"], row["fp"], row["fn"], row["precision"], row["recall"]) == (1, 1, 1, 0.5, 0.5)
    none = mt.off_spec_pr(flags.where("false")).first()
    assert none["precision"] is None
    assert mt.retrain_needed(2.0, 1.0, 0.0, 1.5, 0.2) and not mt.retrain_needed(1.0, 1.0, 0.1, 1.5, 0.2)


def test_off_spec_is_strictly_above(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,)], "v double")
    out = mt.with_off_spec(df, mt.threshold(df, "v", 75), "v")
    assert [r["v"] for r in out.where("is_off_spec").collect()] == [5.0]


def test_psi_of_equal_samples_is_zero(spark):
    df = spark.range(1000).select(F.lit("f").alias("feature"), F.rand(3).alias("value"))
    assert mt.psi(df, df, "feature", "value").first()["psi"] == pytest.approx(0.0)
    assert mt.psi(df, df.withColumn("value", F.col("value") + 1), "feature", "value").first()["psi"] > 1


@pytest.mark.parametrize("block", [5, 1000])
def test_rolling_mae_uses_the_hour_axis(spark, block):
    df = hours(spark, [("p", h, float(h), 0.0) for h in (0, 1, 2, 9)], "plant string, hour_ts timestamp_ntz, predicted double, actual double")
    rows = mt.rolling_mae(df, ["plant"], 3, block=block).orderBy("hour_ts").collect()
    assert [(r["rolling_mae"], r["n_hours"]) for r in rows] == [(0.0, 1), (0.5, 2), (1.0, 3), (9.0, 1)]


def test_replicas_are_marked_and_kept_out(spark):
    df = hours(spark, [(1, 0, 7, 10.0)], "plant_key int, hour_ts timestamp_ntz, rn int, v double")
    out = ft.replicate_plants(df, 2, "plant_key", ["v"], ["rn"], 24, 0.1)
    assert ql.same_rows(out, ft.replicate_plants(df, 2, "plant_key", ["v"], ["rn"], 24, 0.1))
    rows = out.orderBy("plant_key").collect()
    assert [r["is_synthetic"] for r in rows] == [False, True, True] and rows[0]["v"] == 10.0
    assert all(abs(r["v"] - 10) <= 1.0 for r in rows) and rows[1]["v"] != rows[2]["v"]
    dim = out.select("plant_key", "is_synthetic").distinct()
    assert [r["plant_key"] for r in ft.real_only(out, dim).collect()] == [1]


def test_control_chart_and_range(spark):
    df = hours(spark, [("p", h, 10.0 + h % 2) for h in range(20)] + [("p", 20, 99.0)], "plant string, hour_ts timestamp_ntz, v double")
    out = hl.control_chart(df, df.where("v < 50"), "v")
    assert out.where("is_breach").count() == 1
    dim = spark.createDataFrame([("s", 0.0, None), ("t", None, None)], "name string, valid_min double, valid_max double")
    long = spark.createDataFrame([("s", -1.0), ("s", 5.0), ("t", -9.0), ("s", None)], "sensor string, value double")
    assert hl.out_of_range(long, dim).count() == 1


def test_top_drivers_and_latest(spark):
    rows = [("p", 0, f, c) for f, c in (("a", -3.0), ("b", 2.0), ("c", 2.0), ("d", 0.1))]
    df = hours(spark, rows, "plant string, hour_ts timestamp_ntz, feature string, contribution double")
    row = mt.top_drivers(df, ["plant", "hour_ts"]).first()
    assert (row["top_driver_1"], row["top_driver_2"], row["top_driver_3"]) == ("a", "b", "c")
    assert [r["feature"] for r in mt.top_features(mt.global_importance(df), 2).collect()] == ["a", "b"]
    newest = mt.latest(hours(spark, [("p", 1, 5), ("p", 3, 6), ("q", 2, 7)], "k string, hour_ts timestamp_ntz, v int"), ["k"], "hour_ts")
    assert {(r["k"], r["v"]) for r in newest.collect()} == {("p", 6), ("q", 7)}


def test_replica_keys_never_meet(spark):
    rows = [(5, 1.0, datetime(2024, 1, 1)), (1005, 2.0, datetime(2024, 1, 1)), (0, 3.0, datetime(2024, 1, 1))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k long, plant int, value double, hour_ts timestamp_ntz")
    out = ft.replicate_plants(df, 2, "plant", ["value"], ["k"])
    assert out.select("plant").distinct().count() == 9 and dict(out.dtypes)["plant"] == "int"
    assert {r["plant"] for r in out.where("not is_synthetic").collect()} == {0, 5, 1005}


def test_lab_mean_keeps_its_decimals(spark):
    rows = [(datetime(2024, 1, 1), 1.23456789)] * 3 + [(datetime(2024, 1, 1, 1), 0.1234567891), (datetime(2024, 1, 1, 1), 99999.0)]
    df = spark.createDataFrame([(1, *r) for r in rows], "plant int, hour_ts timestamp_ntz, silica double")
    got = {r["hour_ts"].hour: r["silica"] for r in hr.lab_hourly(df, ["plant", "hour_ts"], ["silica"]).collect()}
    assert got[0] == 1.23456789 and got[1] == pytest.approx((0.1234567891 + 99999.0) / 2, abs=1e-10)
    with pytest.raises(ValueError):
        hr.lab_hourly(df, ["plant", "hour_ts"], ["silica"], scale=12)
