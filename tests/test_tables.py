from __future__ import annotations

import os
from datetime import datetime

import pytest
from plantdata import plant_lines, write_csv
from pyspark.sql import functions as F

from assaycast.config import NUMERIC_COLUMNS, SENSORS, Config, load_config
from assaycast.operators import quality as ql
from assaycast.plans import reports as rp
from assaycast.session import get_spark, scratch_dir
from assaycast.sources import raw
from assaycast.sources.serving import export_serving, upsert_statement, write_metrics
from assaycast.sources.tables import Tables, cut_lineage, literal_rows, month_of


@pytest.fixture
def tables(spark, tmp_path):
    cfg = Config()
    cfg.paths.warehouse_root = str(tmp_path)
    return Tables(spark, cfg)


def test_write_read_round_trip(spark, tables):
    df = literal_rows(spark, [(1, "a"), (2, "b")], ["id", "value"])
    tables.overwrite(df, "gold", "smoke")
    back = tables.read("gold", "smoke")
    assert back.count() == 2
    assert [r["value"] for r in back.orderBy("value").collect()] == ["a", "b"]
    tables.append(df, "gold", "smoke")
    assert tables.read("gold", "smoke").count() == 4


@pytest.mark.parametrize("parts", [(), ("month",)])
def test_upsert_is_idempotent(spark, tables, parts):
    def rows(*items):
        df = spark.createDataFrame([(datetime(2017, m, d), v) for m, d, v in items], "ts timestamp_ntz, v int")
        return df.withColumn("month", month_of("ts"))

    tables.upsert(rows((3, 1, 1), (3, 2, 2), (4, 1, 3)), "gold", "t", ["ts"], parts)
    change = rows((3, 2, 20), (5, 1, 5))
    for _ in range(2):
        tables.upsert(change, "gold", "t", ["ts"], parts)
        got = {(r["ts"].month, r["ts"].day): r["v"] for r in tables.read("gold", "t").collect()}
        assert got == {(3, 1): 1, (3, 2): 20, (4, 1): 3, (5, 1): 5}


def test_upsert_leaves_other_partitions_alone(spark, tables):
    df = spark.createDataFrame([(1, 201703), (2, 201704)], "k int, month int")
    tables.upsert(df, "gold", "t", ["k"], ["month"])
    folder = os.path.join(tables.ref("gold", "t"), "month=201704")
    before = sorted(os.listdir(folder))
    tables.upsert(spark.createDataFrame([(3, 201703)], "k int, month int"), "gold", "t", ["k"], ["month"])
    assert sorted(os.listdir(folder)) == before
    assert tables.read("gold", "t").count() == 3


def test_loading_a_batch_again_replaces_it(spark, tables):
    for n in (3, 2):
        tables.replace_partitions(spark.range(n).withColumn("_batch_id", F.lit("b1")), "bronze", "t", ["_batch_id"])
        tables.replace_partitions(spark.range(5).withColumn("_batch_id", F.lit("b2")), "bronze", "t", ["_batch_id"])
    assert tables.as_of_batch("bronze", "t", "b1").count() == 2
    assert tables.read("bronze", "t").count() == 7


def test_table_names_in_a_catalog(spark):
    cfg = Config()
    cfg.catalog.name, cfg.catalog.schema_gold = "main", "gold"
    assert Tables(spark, cfg).ref("gold", "dim_time") == "main.gold.dim_time"


def test_row_numbers_over_splits_and_files(spark, tmp_path):
    lines = plant_lines(days=2, per_hour=30)
    write_csv(tmp_path / "a.csv", lines)
    write_csv(tmp_path / "b.csv", lines[:700])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = raw.bronze_rows(spark, str(tmp_path))
        assert df.select("_source_file", F.spark_partition_id()).distinct().count() > 6
        rows = df.select("_source_file", "_row_number", "date", "`Starch Flow`", "_batch_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, want in (("a.csv", lines), ("b.csv", lines[:700])):
        got = sorted((r["_row_number"], r["date"], r["Starch Flow"]) for r in rows if r["_source_file"].endswith(name))
        assert got == [(i + 1, x[0], x[3]) for i, x in enumerate(want)]
    assert len({r["_batch_id"] for r in rows}) == 2


def test_raw_columns_are_text_and_checked(spark, tmp_path):
    path = write_csv(tmp_path / "p.csv", plant_lines(days=1)[:6])
    df = raw.read_raw(spark, path)
    assert {t for _, t in df.dtypes} == {"string"} and len(df.columns) == 24
    bad = write_csv(tmp_path / "q.csv", [["1"]], ["date"])
    with pytest.raises(ql.CheckFailed):
        raw.read_raw(spark, bad)


def test_config_files(tmp_path):
    (tmp_path / "main.yaml").write_text(
        "mode: local\npaths: {raw_csv: x.csv, warehouse_root: w}\ncatalog: {name: null}\n"
        "postgres: {host: h, port: 5432, database: d, app_rw_user: a, app_rw_password_env: P}\n"
        "ml: {lab_delay_hours: 2, min_hour_completeness_pct: 70, split: {train_start: '2017-03-01'}, horizons: [0, 1]}\n"
        "mlflow: {tracking_uri: u, experiment_name: e}\n"
    )
    cfg = load_config(tmp_path / "main.yaml")
    assert cfg.is_local and cfg.ml.lab_delay_hours == 2 and cfg.ml.horizons == [0, 1]
    assert cfg.dq.hour_completeness.min_completeness_pct == 70
    (tmp_path / "checks.yaml").write_text(
        "sensor_health: {flatline_std_threshold: 1e-6}\nhour_completeness: {min_completeness_pct: 80}\n"
        "ranges: {column_level: [null, 5], ore_pulp_ph: [0, 14]}\n"
    )
    cfg = load_config(tmp_path / "main.yaml", checks=tmp_path / "checks.yaml")
    assert cfg.dq.sensor_health.flatline_std_threshold == 1e-6
    assert cfg.dq.hour_completeness.min_completeness_pct == 80
    assert cfg.range_of("col03_level") == (None, 5.0) and cfg.range_of("ore_pulp_ph") == (0.0, 14.0)
    assert len(NUMERIC_COLUMNS) == 23 and len(SENSORS) == 19


def test_serving_upsert_without_a_database(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    calls = []
    export_serving(df, "jdbc:x", "serving.t", ["k"], {}, execute=calls.append, load=lambda d, t: calls.append((t, d.count())))
    assert calls == [
        ("serving.t_staging", 1),
        "INSERT INTO serving.t (k, v) SELECT k, v FROM serving.t_staging ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v",
    ]
    assert upsert_statement("t", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_metrics_file(spark, tmp_path):
    write_metrics(spark.createDataFrame([("m", 1.0)], "metric string, value double"), str(tmp_path / "m"))
    assert len([f for f in os.listdir(tmp_path / "m") if f.endswith(".json")]) == 1


def test_lineage_is_cut_through_files(spark):
    df = cut_lineage(spark.range(5).withColumn("x", F.rand(1)))
    assert df.inputFiles() and df.count() == 5


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert get_spark(Config()).sparkContext is spark.sparkContext


def test_replay_never_shows_a_later_lab(spark):
    lab = spark.createDataFrame([("p", datetime(2017, 3, 1, h), float(h)) for h in range(10)], "plant string, hour_ts timestamp_ntz, si double")
    pred = lab.select("plant", "hour_ts", F.col("hour_ts").alias("target_hour"), F.lit(0).alias("horizon_h"), F.col("si").alias("predicted"))
    out = rp.replay_as_of(pred, lab, ["plant"], "si", "2017-03-01 06:00:00", 2).orderBy("target_hour").collect()
    assert [r["actual"] for r in out] == [0.0, 1.0, 2.0, 3.0, 4.0, None, None]


def test_pipeline_health_and_scale_report(spark):
    runs = spark.createDataFrame(
        [("a", 1, datetime(2017, 1, 1, 0), datetime(2017, 1, 1, 1), 5), ("a", 10, datetime(2017, 1, 1, 2), datetime(2017, 1, 1, 5), 50)],
        "stage string, scale int, started_at timestamp, finished_at timestamp, rows_out long",
    )
    dq = spark.createDataFrame([("DQ02", True, 0), ("DQ02", False, 3)], "rule_id string, passed boolean, rows_failed long")
    last, rate = rp.pipeline_health(runs, dq)
    assert last.first()["scale"] == 10
    assert rate.first()["pass_rate"] == 0.5
    assert {r["scale"]: r["seconds"] for r in rp.scale_report(runs).collect()} == {1: 3600.0, 10: 10800.0}


@pytest.fixture
def named(spark, tmp_path):
    """Tables by name in the session catalog, with a database of their own."""
    name = f"t{os.urandom(4).hex()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    cfg = Config()
    cfg.catalog.name = "spark_catalog"
    cfg.catalog.schema_bronze = cfg.catalog.schema_silver = cfg.catalog.schema_gold = name
    yield Tables(spark, cfg)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_named_tables_keep_other_batches(spark, named):
    for n in (3, 2):
        named.replace_partitions(spark.range(n).withColumn("_batch_id", F.lit("b1")), "bronze", "t", ["_batch_id"])
        named.replace_partitions(spark.range(5).select(F.lit("b2").alias("_batch_id"), "id"), "bronze", "t", ["_batch_id"])
    assert named.as_of_batch("bronze", "t", "b1").count() == 2
    assert named.read("bronze", "t").count() == 7
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("parts", [(), ("month",)])
def test_named_upsert(spark, named, parts):
    def rows(*items):
        return spark.createDataFrame(list(items), "k int, v int, month int")

    named.upsert(rows((1, 1, 3), (2, 2, 3), (3, 3, 4)), "gold", "t", ["k"], parts)
    for _ in range(2):
        named.upsert(rows((2, 20, 3), (5, 5, 5)), "gold", "t", ["k"], parts)
        assert {tuple(r) for r in named.read("gold", "t").select("k", "v", "month").collect()} == {(1, 1, 3), (2, 20, 3), (3, 3, 4), (5, 5, 5)}


def test_upsert_evaluates_its_source_once(spark, tables):
    tables.upsert(spark.createDataFrame([(1, 1, 3)], "k int, v int, month int"), "gold", "t", ["k"], ["month"])
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.createDataFrame([(1, 2, 3), (4, 4, 4)], "k int, v int, month int").mapInArrow(count, "k int, v int, month int")
    tables.upsert(source, "gold", "t", ["k"], ["month"])
    assert seen.value == 2
