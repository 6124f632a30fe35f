from __future__ import annotations

import json
import os

import pytest
from plantdata import broken, plant_config, plant_lines, write_csv
from pyspark.sql import functions as F

from assaycast.config import RAW_HEADER
from assaycast.operators import features as ft
from assaycast.operators import quality as ql
from assaycast.plans import pages
from assaycast.plans import pipeline as pl
from assaycast.sources.tables import Tables

FIRST = ["ingest_bronze", "build_silver", "dq_checks", "build_gold"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plant")
    lines = broken(plant_lines())
    cfg = plant_config(root / "warehouse", write_csv(root / "plant.csv", lines))
    results = pl.run_pipeline(spark, cfg)
    return cfg, lines, results


def test_all_stages_succeed_and_are_in_the_ledger(spark, run):
    cfg, lines, results = run
    assert [r.status for r in results] == ["success"] * 8
    ledger = Tables(spark, cfg).read("gold", "fact_pipeline_runs").collect()
    assert {r["stage"] for r in ledger} == set(pl.STAGES)
    assert results[0].rows_out == len(lines)


def test_bronze_keeps_text_and_file_order(spark, run):
    cfg, lines, _ = run
    rows = Tables(spark, cfg).read("bronze", "flotation_raw").orderBy("_row_number").collect()
    assert [r["_row_number"] for r in rows] == list(range(1, len(lines) + 1))
    assert [r["starch_flow"] for r in rows] == [x[3] for x in lines]


def test_one_disposition_per_row(spark, run):
    cfg, lines, _ = run
    t = Tables(spark, cfg)
    line = ql.reconcile(t.read("bronze", "flotation_raw"), t.read("silver", "disposed_rows")).first()
    assert line["balanced"] and line["bronze_rows"] == len(lines)
    assert line["quarantined_rows"] == 6 and line["duplicate_rows"] == 3
    rules = t.read("silver", "quarantine").groupBy("rule_id").count().collect()
    assert {r["rule_id"]: r["count"] for r in rules} == {"DQ02": 2, "DQ03": 2, "DQ05": 2}


def test_hours_with_several_lab_values_are_flagged(spark, run):
    cfg, *_ = run
    lab = Tables(spark, cfg).read("silver", "lab_results")
    assert lab.where("lab_is_interpolated").count() == 12
    assert lab.where("lab_is_interpolated AND hour(hour_ts) = 7").count() >= 1


def test_gap_is_recorded(spark, run):
    cfg, *_ = run
    gaps = Tables(spark, cfg).read("silver", "gaps").collect()
    assert [(str(g["gap_start"]), g["missing_hours"]) for g in gaps] == [("2017-03-02 06:00:00", 1)]


def test_row_count_includes_copies(spark, run):
    cfg, lines, _ = run
    hour = lines[20][0]
    row = Tables(spark, cfg).read("gold", "fact_process_hourly").where(F.col("hour_ts") == F.lit(hour)).first()
    assert row["row_count"] == 8
    assert row["completeness_pct"] == pytest.approx(8 * 100 / 6)


def test_second_run_changes_nothing(spark, run):
    cfg, *_ = run
    t = Tables(spark, cfg)
    names = ["fact_process_hourly", "fact_lab_quality", "dim_time", "dim_sensor", "dim_plant", "fact_dq_results"]
    before = {n: t.read("gold", n).collect() for n in names}
    pl.run_pipeline(spark, cfg, FIRST)
    for n in names:
        now = t.read("gold", n)
        old = spark.createDataFrame(before[n], now.schema)
        assert ql.same_rows(old, now), n
        assert ql.compare_builds(old, now, [now.columns[0], now.columns[1]]).isEmpty(), n


def test_predictions_have_bands_drivers_and_confidence(spark, run):
    cfg, *_ = run
    pred = Tables(spark, cfg).read("gold", "fact_predictions")
    assert pred.where("p10 > p50 OR p50 > p90 OR predicted IS NULL").isEmpty()
    assert pred.where("top_driver_1 IS NULL OR top_driver_3 IS NULL").isEmpty()
    assert pred.select("horizon_h").distinct().count() == 2
    assert {r[0] for r in pred.select("confidence").distinct().collect()} <= {"normal", "reduced"}


def test_model_beats_persistence_on_validation(spark, run):
    cfg, *_ = run
    best = Tables(spark, cfg).read("gold", "model_comparison").orderBy("mae").first()
    assert best["skill"] > 0


def test_final_evaluation_runs_once(spark, run):
    cfg, *_ = run
    out = pl.evaluate_final(spark, cfg)
    metrics = {(r["part"], r["metric"]) for r in out.collect()}
    assert ("test_coverage", "coverage") in metrics and ("test_off_spec", "recall") in metrics
    with pytest.raises(RuntimeError):
        pl.evaluate_final(spark, cfg)
    forced = pl.evaluate_final(spark, cfg, force=True)
    assert forced.select("run_id").distinct().count() == 2
    assert Tables(spark, cfg).read("gold", "dim_model").where("test_mae IS NOT NULL").count() == 1


def test_metrics_file(spark, run):
    cfg, *_ = run
    folder = os.path.join(cfg.paths.warehouse_root, "reports", "metrics")
    parts = [f for f in os.listdir(folder) if f.endswith(".json")]
    lines = [json.loads(x) for x in open(os.path.join(folder, parts[0]))]
    assert {"part", "group", "metric", "value"} <= set(lines[0])


def test_drift_of_top_features(spark, run):
    cfg, *_ = run
    out = pl.drift(spark, cfg).collect()
    assert out and all(r["psi"] >= 0 for r in out)


def test_pages(spark, run):
    cfg, *_ = run
    now = pages.quality_now(spark, cfg).collect()
    assert len(now) == 1 and now[0]["lab_value"] is not None and now[0]["lab_hour"] < now[0]["hour_ts"]
    shifts = {r["shift"] for r in pages.trends(spark, cfg, "2017-03-05", "2017-03-06", "B").collect()}
    assert shifts == {"B"}
    importance, tops, reagents = pages.drivers(spark, cfg)
    assert importance.count() > 19 and tops.count() == 479 and 0 < reagents.count() < 479
    heat, issues = pages.sensor_issues(spark, cfg)
    assert heat.count() > 0 and issues.where("is_out_of_range").count() >= 2
    last, rate, rolling = pages.pipeline_health(spark, cfg)
    assert last.count() == 8 and rate.count() >= 5 and rolling.count() > 100
    seen = pages.replay_as_of(spark, cfg, "2017-03-10 10:00:00")
    assert seen.where("actual IS NOT NULL AND target_hour > '2017-03-10 09:00:00'").isEmpty()
    assert pages.shift_comparison(spark, cfg).count() == 3
    assert pages.monitor(spark, cfg).first()["retrain_needed"] in (True, False)


def test_scale_replicas_never_reach_a_model(spark, run):
    cfg, *_ = run
    t = Tables(spark, cfg)
    out = {r["plants"]: r["rows_out"] for r in pages.scale_test(spark, cfg, (1, 3)).collect()}
    assert out[3] == 3 * out[1]
    assert t.read("gold", "dim_plant").where("is_synthetic").count() == 2
    assert pl.feature_table(t, cfg).select("plant_key").distinct().collect() == [(1,)]


def test_loading_instead_of_training(spark, run):
    cfg, *_ = run
    assert pl.train_or_load_model(spark, cfg, retrain=False)[2] == {"action": "loaded"}


def test_leak_audit_of_the_real_builder(spark, run):
    cfg, *_ = run
    t = Tables(spark, cfg)
    process = t.read("gold", "fact_process_hourly")
    feed, lab = t.read("silver", "feed_quality"), t.read("silver", "lab_results")

    def build(p, f, x):
        return ft.assemble_features(p, f, x, cfg)

    assert ft.leak_audit(build, process, feed, lab, "2017-03-05 10:00:00", cfg.ml.lab_delay_hours) == []


def test_feature_count(spark, run):
    cfg, *_ = run
    feat = Tables(spark, cfg).read("gold", "feature_rows")
    assert len(ft.feature_columns(feat, cfg.features.excluded_features, ["plant_key"])) == 19 * 6 * 4 + 2 + 3 + 2


def test_failed_stage_is_recorded_and_raised(spark, tmp_path):
    cfg = plant_config(tmp_path / "w", write_csv(tmp_path / "bad.csv", [["1"]], ["date"]))
    with pytest.raises(ql.CheckFailed, match="DQ01"):
        pl.run_pipeline(spark, cfg)
    row = Tables(spark, cfg).read("gold", "fact_pipeline_runs").collect()
    assert [(r["stage"], r["status"]) for r in row] == [("ingest_bronze", "failed")]


def test_header_without_case(spark, tmp_path):
    lines = plant_lines(days=1)[:12]
    cfg = plant_config(tmp_path / "w", write_csv(tmp_path / "p.csv", lines, [h.upper() for h in RAW_HEADER]))
    assert pl.run_pipeline(spark, cfg, ["ingest_bronze"])[0].rows_out == 12


def test_ragged_lines_are_quarantined_with_their_text(spark, tmp_path):
    lines = plant_lines(days=1)[:12]
    path = write_csv(tmp_path / "p.csv", lines)
    quoted = [",".join(f'"{v}"' for v in x) for x in lines]
    # an extra field, the same line twice, another extra field, an unquoted decimal comma, a short line
    ragged = [quoted[0] + ",3", quoted[0] + ",3", quoted[0] + ',"4,5"', ",".join(lines[1]), quoted[2].rsplit(",\"", 1)[0]]
    with open(path, "a", newline="") as f:
        f.write("".join(x + "\r\n" for x in ragged))
    cfg = plant_config(tmp_path / "w", path)
    pl.run_pipeline(spark, cfg, ["ingest_bronze", "build_silver"])
    t = Tables(spark, cfg)
    bronze = t.read("bronze", "flotation_raw").orderBy("_row_number").collect()
    assert [r["_ragged_line"] for r in bronze] == [None] * 12 + ragged
    bad = t.read("silver", "quarantine").collect()
    assert sorted((r["raw_line"], r["rule_id"], r["copies"]) for r in bad) == sorted((x, "DQ01", ragged.count(x)) for x in set(ragged))
    assert t.read("silver", "process_readings").count() == 12
    line = ql.reconcile(t.read("bronze", "flotation_raw"), t.read("silver", "disposed_rows")).first()
    assert line["balanced"] and line["bronze_rows"] == 17
