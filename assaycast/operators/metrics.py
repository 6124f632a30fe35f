"""Error, detection, coverage, drift and profile measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaycast.functions.columns import epoch_hour, shift_of
from assaycast.functions.stats import exact_percentile, exact_percentiles
from assaycast.operators.calendar import HOUR
from assaycast.operators.segments import home_rows, with_segments


def threshold(train: DataFrame, value: str, percentile: float = 75) -> DataFrame:
    """Off-spec limit: percentile of the training values, one row."""
    return exact_percentile(train, value, percentile / 100.0, "threshold")


def with_off_spec(df: DataFrame, limit: DataFrame, value: str, name: str = "is_off_spec") -> DataFrame:
    """Strictly above the limit (a one-row frame)."""
    return df.withColumn(name, F.col(value) > limit.scalar())


def _err(pred: str, actual: str) -> Column:
    return F.col(pred) - F.col(actual)


def error_metrics(df: DataFrame, by: Sequence[str] = (), pred: str = "predicted", actual: str = "actual") -> DataFrame:
    e = _err(pred, actual)
    return df.groupBy(*by).agg(
        F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse")
    )


def skill(
    df: DataFrame, by: Sequence[str] = (), pred: str = "predicted", base: str = "persistence", actual: str = "actual"
) -> DataFrame:
    """1 - MAE(model) / MAE(persistence), on the rows that have both."""
    both = df.where(F.col(pred).isNotNull() & F.col(base).isNotNull() & F.col(actual).isNotNull())
    m, p = F.avg(F.abs(_err(pred, actual))), F.avg(F.abs(_err(base, actual)))
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        m.alias("mae"),
        F.sqrt(F.avg(_err(pred, actual) * _err(pred, actual))).alias("rmse"),
        p.alias("persistence_mae"),
        (1 - F.try_divide(m, p)).alias("skill"),
    )


def compare_models(df: DataFrame) -> DataFrame:
    """One line per model on the validation rows."""
    return skill(df, ["model"])


def horizon_curve(df: DataFrame) -> DataFrame:
    return skill(df, ["horizon_h"])


def off_spec_pr(df: DataFrame, by: Sequence[str] = (), pred: str = "pred_off_spec", actual: str = "is_off_spec") -> DataFrame:
    both = df.where(F.col(pred).isNotNull() & F.col(actual).isNotNull())
    tp = F.count_if(F.col(pred) & F.col(actual))
    fp = F.count_if(F.col(pred) & ~F.col(actual))
    fn = F.count_if(~F.col(pred) & F.col(actual))
    return both.groupBy(*by).agg(
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
        F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"),
    )


def coverage(df: DataFrame, by: Sequence[str] = (), low: str = "p10", high: str = "p90", actual: str = "actual") -> DataFrame:
    known = df.where(F.col(actual).isNotNull() & F.col(low).isNotNull())
    inside = F.col(actual).between(F.col(low), F.col(high))
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("n_inside"),
        F.try_divide(F.count_if(inside), F.count(F.lit(1))).alias("coverage"),
    )


def psi(
    train: DataFrame, current: DataFrame, feature: str, value: str, bins: int = 10, eps: float = 1e-4
) -> DataFrame:
    """Population stability index per feature over the training deciles.

    ``feature`` is a bounded set of names, so the edges are one small map and each value finds its bin where it
    lies: rows are counted per feature and bin before any shuffle.
    """
    shares = {f"_e{i}": i / bins for i in range(1, bins)}
    edges = exact_percentiles(train, value, shares, [feature]).select(
        feature, F.array(*shares).alias("_edges")
    )
    rows = train.select(feature, value, F.lit(1).alias("_t")).unionByName(
        current.select(feature, value, F.lit(0).alias("_t"))
    )
    table = edges.agg(F.map_from_entries(F.collect_list(F.struct(feature, "_edges")))).scalar()
    placed = rows.where(F.col(value).isNotNull()).withColumn("_edges", F.try_element_at(table, F.col(feature)))
    placed = placed.where(F.col("_edges").isNotNull())
    bin_no = F.size(F.filter("_edges", lambda e: e < F.col(value)))
    counts = placed.groupBy(feature, bin_no.alias("_bin")).agg(
        F.count_if(F.col("_t") == 1).alias("_p"), F.count_if(F.col("_t") == 0).alias("_q")
    )
    # one row per feature with its few bins
    bins_of = counts.groupBy(feature).agg(
        F.array_sort(F.collect_list(F.struct("_bin", "_p", "_q"))).alias("_bins"), F.sum("_p").alias("_np"), F.sum("_q").alias("_nq")
    )

    def term(b):
        p = F.greatest(b["_p"] / F.col("_np"), F.lit(eps))
        q = F.greatest(F.try_divide(b["_q"], F.col("_nq")), F.lit(eps))
        return (p - q) * F.ln(p / q)

    total = F.aggregate(F.transform("_bins", term), F.lit(0.0), lambda acc, t: acc + t)
    return bins_of.select(feature, total.alias("psi"))


def rolling_mae(
    df: DataFrame, keys: Sequence[str], hours: int = 168, hour: str = HOUR, block: int = 2_000,
    pred: str = "predicted", actual: str = "actual",
) -> DataFrame:
    """MAE over the last ``hours`` hours of the hour axis, one row per hour and key."""
    known = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull()).withColumn("_h", epoch_hour(hour))
    runs = with_segments(known, "_h", max(block, hours), hours - 1)
    span = Window.partitionBy(*keys, "_segment").orderBy("_h").rangeBetween(-(hours - 1), 0)
    out = runs.withColumns(
        {"rolling_mae": F.avg(F.abs(_err(pred, actual))).over(span), "n_hours": F.count(F.lit(1)).over(span)}
    )
    return home_rows(out).select(*keys, hour, "rolling_mae", "n_hours")


def off_spec_by_shift(df: DataFrame, by: Sequence[str] = (), start: int = 6, hour: str = HOUR) -> DataFrame:
    n, bad = F.count(F.lit(1)), F.count_if("is_off_spec")
    return df.groupBy(*by, shift_of(hour, start).alias("shift")).agg(
        n.alias("n_hours"), bad.alias("off_spec_hours"), (bad / n).alias("off_spec_rate")
    )


def correlation(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.corr(a, b).alias("correlation"), F.count(F.lit(1)).alias("n"))


def profile_rows_per_hour(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many hours have how many rows."""
    per = df.groupBy(*keys, HOUR).agg(F.count(F.lit(1)).alias("rows_in_hour"))
    return per.groupBy("rows_in_hour").agg(F.count(F.lit(1)).alias("n_hours"))


def profile_distinct(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How many hours have how many distinct values."""
    distinct = df.groupBy(*keys, HOUR, value).agg(F.lit(1).alias("_x"))
    per = distinct.groupBy(*keys, HOUR).agg(F.count(value).alias("distinct_values"))
    return per.groupBy("distinct_values").agg(F.count(F.lit(1)).alias("n_hours"))


def health_heatmap(health: DataFrame) -> DataFrame:
    """Flagged hours per sensor and day, long form."""
    return health.groupBy("sensor", F.to_date(HOUR).alias("day")).agg(
        F.count_if("is_flatline").alias("flatline_hours"),
        F.count_if("is_out_of_range").alias("out_of_range_hours"),
        F.count_if("has_spike").alias("spike_hours"),
    )


def global_importance(contrib: DataFrame) -> DataFrame:
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))


def top_drivers(contrib: DataFrame, keys: Sequence[str], k: int = 3) -> DataFrame:
    """The k largest contributions of each hour as columns ``top_driver_1..k``.

    A group is one hour's features, a number fixed by the configuration.
    """
    order = Window.partitionBy(*keys).orderBy(F.abs("contribution").desc(), "feature")
    ranked = contrib.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return ranked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_r") == i, F.col("feature"))).alias(f"top_driver_{i}") for i in range(1, k + 1)]
    )


def top_features(importance: DataFrame, k: int = 5) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(k)


def latest(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Newest row of each group, by an aggregate with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return top.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def retrain_needed(mae: float, reference_mae: float, worst_psi: float, mae_ratio: float, psi_limit: float) -> bool:
    """The documented trigger: recent error or drift beyond its limit."""
    return mae > mae_ratio * reference_mae or worst_psi > psi_limit
