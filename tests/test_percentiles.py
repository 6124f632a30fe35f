from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from assaycast.functions import stats
from assaycast.functions.stats import exact_percentiles, ordered_key
from assaycast.operators.metrics import psi

SHARES = {"a": 0.0, "b": 0.13, "c": 0.5, "d": 0.75, "e": 1.0}
ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2),
       2.0**0.5, 1.7976931348623157e308, -1.7976931348623157e308, 4503599627370497.0, -3.5, 1e-300, math.inf, -math.inf]


def test_keys_order_as_the_values(spark):
    rng = random.Random(3)
    values = ODD + [math.nextafter(2.0**e, s) for e in range(-1074, 1024, 7) for s in (0, math.inf)] + [2.0**e for e in range(-1074, 1024)]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3).select("v", ordered_key(F.col("v")).alias("k"))
    rows = sorted((r["v"], r["k"]) for r in df.collect())
    for (v, k), (w, m) in zip(rows, rows[1:]):
        assert (k == m) if v == w else (k < m), (v, w)
    nan = spark.sql("SELECT double('NaN') AS v").select(ordered_key(F.col("v")).alias("k")).first()["k"]
    assert nan > rows[-1][1]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some.lists(some.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=40))
def test_any_doubles_equal_numpy(spark, values):
    row = exact_percentiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", SHARES).first()
    for name, q in SHARES.items():
        assert row[name] == pytest.approx(np.quantile(values, q), rel=1e-9)


def grouped(spark):
    """A group with two thirds of the rows, one row, a null key, null and equal values, neighbours in the last bit."""
    rng = random.Random(5)
    rows = [("hot", rng.gauss(0, 1) * 10.0 ** rng.randrange(-9, 9)) for _ in range(2000)] + [("one", 7.25)]
    rows += [(None, float(k)) for k in range(400)] + [("same", 3.0)] * 300 + [("none", None)] * 5
    rows += [("close", math.nextafter(1.0, 2) if k % 3 else 1.0) for k in range(100)]
    return rows, spark.createDataFrame(rows, "key string, v double").repartition(6)


@pytest.mark.parametrize("most,bins", [(256, 65_536), (1, 64)])
def test_groups_by_lookup_and_by_join(spark, monkeypatch, most, bins):
    monkeypatch.setattr(stats, "LOOKUP_GROUPS", most)
    rows, df = grouped(spark)
    got = {r["key"]: r for r in exact_percentiles(df, "v", SHARES, ["key"], accuracy=bins).collect()}
    assert set(got) == {"hot", "one", None, "same", "close"}
    for key, row in got.items():
        own = [v for k, v in rows if k == key]
        for name, q in SHARES.items():
            assert row[name] == pytest.approx(np.quantile(own, q), rel=1e-12), (key, name)


def test_no_rows(spark):
    none = spark.createDataFrame([], "key string, v double")
    assert exact_percentiles(none, "v", SHARES, ["key"]).count() == 0
    assert list(exact_percentiles(none, "v", SHARES).first()) == [None] * 5
    assert list(exact_percentiles(spark.createDataFrame([(None,)], "v double"), "v", SHARES).first()) == [None] * 5


def test_nan_is_the_largest_and_infinities_stay(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, math.inf, math.inf, math.nan, -math.inf)], "v double")
    row = exact_percentiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}).first()
    assert [row["a"], row["b"], row["c"], row["d"]] == [-math.inf, 1.0, math.inf, math.inf] and math.isnan(row["e"])


def test_many_equal_values_per_key(spark):
    df = spark.range(0, 300_000, 1, 4).select((F.col("id") % 2).alias("key"), (F.col("id") % 1000 / 10).alias("v"))
    got = {r["key"]: r["m"] for r in exact_percentiles(df, "v", {"m": 0.5}, ["key"]).collect()}
    for key in (0, 1):
        assert got[key] == pytest.approx(np.quantile([k % 1000 / 10 for k in range(key, 1000, 2)], 0.5))


def test_psi_has_no_join_and_no_window(spark, capsys):
    df = spark.range(4000).select((F.col("id") % 2).cast("string").alias("f"), F.sqrt(F.col("id")).alias("v"))
    out = psi(df.where("v < 50"), df.where("v >= 20"), "f", "v")
    out.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Window" not in plan
    assert out.count() == 2
