from __future__ import annotations

from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from assaycast.operators import features as ft
from assaycast.operators import models as md

KEYS = ["plant", "hour_ts"]
COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    import random

    rng = random.Random(5)
    out = []
    for i in range(600):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        c = None if i % 10 == 0 else rng.gauss(0, 1)
        y = 3 * a - 2 * b + rng.gauss(0, 0.3)
        split = "train" if i < 350 else "val" if i < 450 else "test"
        out.append((1, datetime(2017, 3, 1) + timedelta(hours=i), a, b, c, None, y, y + rng.gauss(0, 0.01), split))
    schema = "plant int, hour_ts timestamp_ntz, a double, b double, c double, empty double, target double, twin double, split string"
    return spark.createDataFrame(out, schema).cache()


def part(rows, name):
    return rows.where(F.col("split") == name)


def mae(df):
    return df.agg(F.avg(F.abs(F.col("predicted") - F.col("target")))).first()[0]


@pytest.fixture(scope="module")
def ridge(rows):
    return md.fit_ridge(part(rows, "train"), COLS + ["empty"], 0.01)


@pytest.fixture(scope="module")
def forest(rows):
    return md.fit_forest(part(rows, "train"), COLS, 10, 5)


def test_models_learn(rows, ridge, forest):
    gbt = md.fit_gbt(part(rows, "train"), COLS, 8, 3)
    test = part(rows, "test")
    spread = test.agg(F.avg(F.abs(F.col("target")))).first()[0]
    assert mae(md.score(ridge, test)) < 0.4
    assert mae(md.score(gbt, test)) < 0.6 * spread
    assert mae(md.score(forest, test)) < 0.6 * spread
    assert ridge.columns == COLS  # a column without values is not used


def test_linear_drivers_add_up(rows, ridge):
    test = part(rows, "test")
    total = md.linear_contributions(test, KEYS, md.ridge_weights(ridge), ridge.means).groupBy(*KEYS).agg(F.sum("contribution").alias("s"))
    base = ridge.model.intercept + sum(md.ridge_weights(ridge)[c] * ridge.means[c] for c in COLS)
    off = md.score(ridge, test).join(total, KEYS).agg(F.max(F.abs(F.col("predicted") - F.col("s") - base))).first()[0]
    assert off < 1e-9


def test_group_drivers_add_up_and_match_the_linear_ones(rows, ridge):
    test = part(rows, "test")
    groups = {"ga": ["a"], "gbc": ["b", "c"]}
    sampled = md.group_contributions(ridge, test, KEYS, groups, 2)
    exact = md.linear_contributions(test, KEYS, md.ridge_weights(ridge), ridge.means, groups)
    both = sampled.join(exact.withColumnRenamed("contribution", "exact"), [*KEYS, "feature"])
    assert both.count() == 2 * test.count()
    assert both.agg(F.max(F.abs(F.col("contribution") - F.col("exact")))).first()[0] < 1e-9


def test_forest_quantiles(rows, forest):
    fq = md.fit_forest_quantiles(part(rows, "train"), forest, 20)
    out = md.predict_quantiles(fq, part(rows, "test"), KEYS, {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    assert out.count() == part(rows, "test").count()
    assert out.where("p10 > p50 OR p50 > p90").isEmpty()
    inside = out.join(part(rows, "test"), KEYS).agg(F.avg(F.col("target").between(F.col("p10"), F.col("p90")).cast("double"))).first()[0]
    assert inside > 0.6


def test_conformal_band(rows, ridge):
    scored = md.score(ridge, rows).withColumnRenamed("target", "actual")
    band = md.conformal(part(scored, "val"), part(scored, "test"), 0.8)
    inside = band.agg(F.avg(F.col("actual").between(F.col("p10"), F.col("p90")).cast("double"))).first()[0]
    assert 0.65 < inside < 0.95


def test_walk_forward_and_choice(rows):
    folds = ft.expanding_folds("2017-03-08", 2, 4)
    folded = ft.assign_folds(rows.where("split != 'test'"), folds)
    grid = {f"ridge-{r:g}": (lambda d, c, r=r: md.fit_ridge(d, c, r)) for r in (0.01, 100.0)}
    cv = md.walk_forward_cv(folded, COLS, grid, [0, 1])
    assert {r["model"]: r["n_folds"] for r in cv.collect()} == {"ridge-0.01": 2, "ridge-100": 2}
    assert md.best_model(cv) == "ridge-0.01"


def test_ablation_shows_the_leak(rows):
    out = md.ablation(rows, COLS, ["twin"], lambda d, c: md.fit_ridge(d, c, 0.001), KEYS)
    found = {(r["with_iron"], r["split"]): r["mae"] for r in out.collect()}
    assert len(found) == 4
    assert found[("yes", "time")] < found[("no", "time")] / 3


def test_save_and_load(rows, ridge, tmp_path):
    md.save_model(ridge, str(tmp_path / "m"))
    again = md.load_model(str(tmp_path / "m"))
    assert again.columns == ridge.columns and again.hash == ridge.hash
    test = part(rows, "test")
    off = md.score(ridge, test, "x").join(md.score(again, test, "y").select(*KEYS, "y"), KEYS)
    assert off.where("abs(x - y) > 1e-12").isEmpty()


def test_hash_ignores_the_order_of_columns():
    from assaycast.functions.columns import features_hash

    assert features_hash(["a", "b"]) == features_hash(["b", "a"]) != features_hash(["a"])


def test_orders_come_with_their_reverse(spark):
    class Products:
        def transform(self, df):
            x = vector_to_array("features")
            return df.withColumn("prediction", x[0] * x[1] + x[1] * x[2] + 3 * x[2])

    fitted = SimpleNamespace(columns=["a", "b", "c"], means={"a": 0.0, "b": 0.0, "c": 0.0}, pipeline=Products())
    feat = spark.createDataFrame([(1, 2.0, 3.0, 5.0)], "k int, a double, b double, c double")
    for permutations in ({}, {"permutations": 2}):
        got = md.group_contributions(fitted, feat, ["k"], {"a": ["a"], "b": ["b"], "c": ["c"]}, **permutations).collect()
        assert {r["feature"]: r["contribution"] for r in got} == pytest.approx({"a": 3.0, "b": 10.5, "c": 22.5})
