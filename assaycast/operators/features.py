"""Leak-free hourly features, targets and folds.

Hourly tables are keyed by plant and hour. Lags look at the hour axis, never at the row before, so a
missing hour gives null. Hours are cut into blocks with the lag hours copied over the border, so a
single plant is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaycast.config import Config
from assaycast.functions.columns import epoch_hour, hour_from_epoch
from assaycast.operators.calendar import HOUR
from assaycast.operators.segments import home_rows, with_segments


def lagged(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], lags: Sequence[int], block: int = 2_000
) -> DataFrame:
    """Add ``<value>_lag<k>``: the value exactly k hours earlier."""
    runs = with_segments(df.withColumn("_h", epoch_hour(HOUR)), "_h", block, max(lags))
    along = Window.partitionBy(*keys, "_segment").orderBy("_h")
    held = {f"_lag{k}": F.first(F.struct(*values)).over(along.rangeBetween(-k, -k)) for k in lags}
    out = home_rows(runs.withColumns(held))
    flat = [F.col(f"_lag{k}.{v}").alias(f"{v}_lag{k}") for k in lags for v in values]
    return out.select(*df.columns, *flat)


def shifted(df: DataFrame, keys: Sequence[str], value: str, lags: dict[str, int]) -> DataFrame:
    """Rows moved k hours ahead, one column per entry: the value known k hours before the row's hour."""
    places = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("k")) for n, k in lags.items()])
    moved = df.where(F.col(value).isNotNull()).select(*keys, HOUR, value, F.explode(places).alias("_p"))
    moved = moved.withColumn(HOUR, hour_from_epoch(epoch_hour(HOUR) + F.col("_p.k")))
    return moved.groupBy(*keys, HOUR).agg(
        *[F.max(F.when(F.col("_p.name") == n, F.col(value))).alias(n) for n in lags]
    )


def mask_interpolated(lab: DataFrame, values: Sequence[str], flag: str = "lab_is_interpolated") -> DataFrame:
    """Null the lab values of interpolated hours: they leak the next assay."""
    return lab.withColumns({v: F.when(~F.col(flag), F.col(v)) for v in values})


def lab_lags(lab: DataFrame, keys: Sequence[str], value: str, delay: int, items: Sequence[int]) -> DataFrame:
    """Lab value at h-L, h-L-1, ...: item i is i-1 hours before the cut-off."""
    return shifted(lab, keys, value, {f"lab_lag{i}": delay + i - 1 for i in items})


def at_horizons(df: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Each hour once per horizon, with its target hour."""
    ks = F.explode(F.array(*[F.lit(int(k)) for k in horizons]))
    out = df.withColumn("horizon_h", ks)
    return out.withColumn("target_hour", hour_from_epoch(epoch_hour(HOUR) + F.col("horizon_h")))


def with_targets(feat: DataFrame, lab: DataFrame, keys: Sequence[str], value: str, horizons: Sequence[int]) -> DataFrame:
    """Target at h+k; the features stop at h. ``lab`` must be masked already."""
    target = lab.where(F.col(value).isNotNull()).select(
        *keys, F.col(HOUR).alias("target_hour"), F.col(value).alias("target")
    )
    return at_horizons(feat, horizons).join(target, [*keys, "target_hour"])


def persistence(lab: DataFrame, keys: Sequence[str], value: str, delay: int, horizons: Sequence[int]) -> DataFrame:
    """Forecast from hour h for h+k: the lab value of h-L."""
    known = shifted(lab, keys, value, {"predicted": delay})
    return at_horizons(known, horizons)


def carry_forward(df: DataFrame, keys: Sequence[str], values: Sequence[str], position: str, block: int = 2_000) -> DataFrame:
    """Last non-null value at or before each row, over groups of any length.

    Inside a block by a window; into a block from the last value of the blocks before it.
    """
    d = df.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    inner = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = d.groupBy(*keys, "_block").agg(
        *[F.max(F.when(F.col(v).isNotNull(), F.struct(position, v))).alias(f"_e_{v}") for v in values]
    )
    carried = ends.select(
        *keys, "_block", *[F.last(f"_e_{v}", ignorenulls=True).over(earlier)[v].alias(f"_b_{v}") for v in values]
    )
    local = d.withColumns({f"_i_{v}": F.last(v, ignorenulls=True).over(inner) for v in values})
    out = local.join(carried, [*keys, "_block"], "left")
    return out.select(*df.columns, *[F.coalesce(f"_i_{v}", f"_b_{v}").alias(f"last_{v}") for v in values])


def lab_visible(spine: DataFrame, lab: DataFrame, keys: Sequence[str], value: str, delay: int) -> DataFrame:
    """Last lab value known at each hour of the spine: assays up to h-L, looked up backwards."""
    known = lab.where(F.col(value).isNotNull()).select(
        *keys,
        hour_from_epoch(epoch_hour(HOUR) + delay).alias(HOUR),
        F.col(value).alias("lab_value"),
        F.col(HOUR).alias("lab_hour"),
        F.lit(False).alias("_asked"),
    )
    asked = spine.select(
        *keys, HOUR, F.lit(None).cast("double").alias("lab_value"), F.lit(None).cast("timestamp_ntz").alias("lab_hour"),
        F.lit(True).alias("_asked"),
    )
    # one row per hour: an answer and a question of the same hour meet, the answer being visible
    both = known.unionByName(asked).groupBy(*keys, HOUR).agg(
        F.max("lab_value").alias("lab_value"), F.max("lab_hour").alias("lab_hour"), F.max("_asked").alias("_asked")
    )
    filled = carry_forward(both.withColumn("_h", epoch_hour(HOUR)), keys, ["lab_value", "lab_hour"], "_h")
    return filled.where("_asked").select(
        *keys, HOUR, F.col("last_lab_value").alias("lab_value"), F.col("last_lab_hour").alias("lab_hour")
    )


def with_calendar(df: DataFrame, shift_start: int = 6) -> DataFrame:
    hour = F.hour(HOUR)
    return df.withColumns(
        {"hour_of_day": hour, "shift_no": F.floor(F.pmod(hour - F.lit(shift_start), F.lit(24)) / 8).cast("int")}
    )


def assemble_features(
    process: DataFrame,
    feed: DataFrame,
    lab: DataFrame,
    cfg: Config,
    keys: Sequence[str] = ("plant_key",),
    values: Sequence[str] | None = None,
    silica: str = "pct_silica_concentrate",
    feed_values: Sequence[str] = ("pct_iron_feed", "pct_silica_feed"),
) -> DataFrame:
    """Process statistics, their lags, feed of the hour, lab lags, calendar: one row per plant and hour.

    ``process``: hourly statistics; ``lab``: hourly lab rows with the interpolation flag.
    """
    keys = list(keys)
    if values is None:
        values = [f"{s}_{a}" for s in cfg.features.process_sensors for a in cfg.features.hourly_aggregates]
    lags = lab_lags(
        mask_interpolated(lab, [silica]), keys, silica, cfg.ml.lab_delay_hours, cfg.features.lab_silica_lag_hours
    )
    base = lagged(process.select(*keys, HOUR, *values), keys, values, cfg.features.sensor_lag_hours, cfg.sizes.hour_block)
    out = base.join(feed.select(*keys, HOUR, *feed_values), [*keys, HOUR], "left").join(lags, [*keys, HOUR], "left")
    return with_calendar(out, cfg.ml.shift_starts_hour)


def feature_columns(df: DataFrame, excluded: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Model inputs of a feature table; an excluded column or a lag of it is an error."""
    other = {*keys, HOUR, "target", "target_hour", "horizon_h", "split"}
    cols = [c for c in df.columns if c not in other]
    barred = [c for c in cols if any(c == e or c.startswith(f"{e}_") for e in excluded)]
    if barred:
        raise ValueError(f"excluded columns among the features: {barred}")
    return cols


def training_hours(feat: DataFrame, eligible: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only hours that are complete enough; interpolated targets are already null."""
    return feat.join(eligible.select(*keys, HOUR), [*keys, HOUR], "left_semi")


def leak_audit(
    build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame],
    process: DataFrame,
    feed: DataFrame,
    lab: DataFrame,
    hour: str,
    delay: int,
    excluded: Sequence[str] = ("pct_iron_concentrate",),
) -> list[str]:
    """Problems of a feature builder at one hour; an empty list means none found.

    All numbers after the cut-off (lab: after h-L) are changed and the hour is built again. Features
    that differ must have looked at them.
    """
    cutoff = F.lit(hour).cast("timestamp_ntz")

    def disturbed(df: DataFrame, back: int) -> DataFrame:
        late = epoch_hour(HOUR) > epoch_hour(cutoff) - back
        numbers = [c for c, t in df.dtypes if t in ("double", "float")]
        return df.withColumns({c: F.when(late, F.col(c) * 3.0 + 1000.0).otherwise(F.col(c)) for c in numbers})

    plain = build(process, feed, lab).where(F.col(HOUR) == cutoff)
    problems = [f"excluded column {c}" for c in plain.columns for e in excluded if c == e or c.startswith(f"{e}_")]
    for name, tables in {
        "process": (disturbed(process, 0), feed, lab),
        "feed": (process, disturbed(feed, 0), lab),
        "lab": (process, feed, disturbed(lab, delay)),
    }.items():
        again = build(*tables).where(F.col(HOUR) == cutoff)
        if not plain.exceptAll(again).isEmpty() or not again.exceptAll(plain).isEmpty():
            problems.append(f"features use {name} rows after the cut-off")
    return problems


def expanding_folds(start: str, n: int, step_days: int) -> list[tuple[int, datetime, datetime]]:
    """(fold, end of training, end of validation), each fold with ``step_days`` more history."""
    first = datetime.fromisoformat(start)
    step = timedelta(days=step_days)
    return [(i, first + i * step, first + (i + 1) * step) for i in range(n)]


def assign_folds(df: DataFrame, folds: Sequence[tuple[int, datetime, datetime]], hour: str = HOUR) -> DataFrame:
    """Each hour in every fold it belongs to, as train (before the cut) or val (up to the fold's end)."""

    def moment(t: datetime) -> Column:
        return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")

    roles = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(hour) < moment(stop),
                    F.struct(
                        F.lit(i).alias("fold"),
                        F.when(F.col(hour) < moment(cut), "train").otherwise("val").alias("role"),
                    ),
                )
                for i, cut, stop in folds
            ]
        )
    )
    return df.withColumn("_f", F.explode(roles)).withColumns({"fold": F.col("_f.fold"), "role": F.col("_f.role")}).drop("_f")


def visible_at(df: DataFrame, available: Column | str, replay_hour: str) -> DataFrame:
    """Rows known at the replay hour."""
    c = F.col(available) if isinstance(available, str) else available
    return df.where(c <= F.lit(replay_hour).cast("timestamp_ntz"))


def replicate_plants(
    df: DataFrame, copies: int, plant: str, values: Sequence[str], row_key: Sequence[str],
    shift_hours: int = 24, noise: float = 0.01, seed: int = 7, first_key: int = 1 << 30,
) -> DataFrame:
    """Synthetic plants: shifted in time, with noise that depends only on the row, plant and seed.

    Originals come first, unchanged; copies carry ``is_synthetic``. Real keys lie from 0 to below
    ``first_key``; copy c of plant p gets ``first_key`` + p * copies + c - 1, different for every p and c. Every row
    makes its own copies, so the work stays where the rows are.
    """
    numbers = F.explode(F.sequence(F.lit(0), F.lit(copies)))
    made = df.withColumn("_copy", numbers).withColumn("is_synthetic", F.col("_copy") > 0)

    def noisy(v: str) -> Column:
        parts = F.concat_ws("|", *[F.col(k).cast("string") for k in row_key], F.col("_copy"), F.lit(v), F.lit(seed))
        # first 8 hex digits of a digest: the same number on every engine
        unit = F.conv(F.substring(F.md5(parts), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        return F.when(F.col("_copy") == 0, F.col(v)).otherwise(F.col(v) * (1 + F.lit(2 * noise) * (unit - 0.5)))

    out = made.withColumns(
        {
            **{v: noisy(v) for v in values},
            HOUR: hour_from_epoch(epoch_hour(HOUR) + F.col("_copy") * shift_hours),
            plant: F.when(F.col("_copy") == 0, F.col(plant))
            .otherwise(F.lit(first_key) + F.col(plant) * copies + F.col("_copy") - 1)
            .cast(df.schema[plant].dataType),
        }
    )
    return out.drop("_copy")


def real_only(df: DataFrame, dim_plant: DataFrame, plant: str = "plant_key") -> DataFrame:
    """Rows of real plants; synthetic ones never reach a model."""
    return df.join(dim_plant.where(~F.col("is_synthetic")).select(plant), plant, "left_semi")
