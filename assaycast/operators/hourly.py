"""Hourly statistics, lab and feed collapse, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaycast.operators.segments import cut


def hourly_stats(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    chunk: Sequence[Column],
    tail_rows: int = 45,
    copies: str | None = None,
    aggregates: Sequence[str] = ("mean", "std", "min", "max", "last_15min_mean", "slope"),
) -> DataFrame:
    """Per group and value: mean, std, min, max, mean of the last rows, slope over the row ordinal.

    One shuffle of the rows on keys and chunk, so that no task holds more than a chunk of a hot hour.
    Each chunk is reduced to moments and its last ``tail_rows`` rows; only these small partials are
    shuffled on the keys and merged. The merge is the pairwise update of centred moments, so it loses
    no digits. ``row_count`` counts the removed copies too when ``copies`` names their number.
    """
    keys, values = list(keys), list(values)
    df, names = cut(df, chunk)
    weight = F.col(copies) if copies else F.lit(1)
    base = df.select(*keys, *names, *order, *values, weight.cast("long").alias("_w"))

    group = Window.partitionBy(*keys, *names)
    rows = base.withColumn("_i", F.row_number().over(group.orderBy(*order)))
    need_tail = "last_15min_mean" in aggregates
    if need_tail:
        rows = rows.withColumn("_r", F.count(F.lit(1)).over(group) - F.col("_i") + 1)

    parts = [F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_rows")]
    for v in values:
        x = F.when(F.col(v).isNotNull(), F.col("_i").cast("double"))
        parts += [
            F.count(v).alias(f"_n_{v}"),
            F.avg(v).alias(f"_m_{v}"),
            F.var_pop(v).alias(f"_v_{v}"),
            F.min(v).alias(f"_lo_{v}"),
            F.max(v).alias(f"_hi_{v}"),
        ]
        if "slope" in aggregates:
            parts += [
                F.avg(x).alias(f"_mx_{v}"),
                F.var_pop(x).alias(f"_vx_{v}"),
                F.covar_pop(v, x).alias(f"_c_{v}"),
            ]
    if need_tail:
        last = F.when(F.col("_r") <= tail_rows, F.struct("_r", *values))
        parts.append(F.collect_list(last).alias("_tail"))
    partial = rows.groupBy(*keys, *names).agg(*parts)

    along = Window.partitionBy(*keys).orderBy(*names)
    whole = Window.partitionBy(*keys)
    earlier = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    later = F.sum("_n").over(along.rowsBetween(1, Window.unboundedFollowing))
    shifted = partial.withColumns(
        {"_before": F.coalesce(earlier, F.lit(0)), "_after": F.coalesce(later, F.lit(0))}
    )
    centres = {}
    for v in values:
        n = F.col(f"_n_{v}")
        centres[f"_all_{v}"] = F.try_divide(F.sum(n * F.col(f"_m_{v}")).over(whole), F.sum(n).over(whole))
        if "slope" in aggregates:
            x = F.col(f"_mx_{v}") + F.col("_before")
            centres[f"_allx_{v}"] = F.try_divide(F.sum(n * x).over(whole), F.sum(n).over(whole))
    merged = shifted.withColumns(centres)

    out = [F.sum("_rows").alias("row_count")]
    for v in values:
        n = F.col(f"_n_{v}")
        dv = F.col(f"_m_{v}") - F.col(f"_all_{v}")
        total = F.sum(n)
        if "mean" in aggregates:
            out.append(F.max(f"_all_{v}").alias(f"{v}_mean"))
        if "std" in aggregates:
            spread = F.sum(n * F.col(f"_v_{v}") + n * dv * dv)
            out.append(F.when(total > 1, F.sqrt(spread / (total - 1))).alias(f"{v}_std"))
        if "min" in aggregates:
            out.append(F.min(f"_lo_{v}").alias(f"{v}_min"))
        if "max" in aggregates:
            out.append(F.max(f"_hi_{v}").alias(f"{v}_max"))
        if need_tail:
            seen = _tail_values(v, tail_rows)
            # rows of one chunk arrive in no fixed order: sort, so that repeated runs agree to the bit
            add = F.aggregate(F.array_sort(seen), F.lit(0.0), lambda total, x: total + x.cast("double"))
            mean = F.try_divide(F.sum(add), F.sum(F.size(seen)))
            out.append(mean.alias(f"{v}_last_15min_mean"))
        if "slope" in aggregates:
            dx = F.col(f"_mx_{v}") + F.col("_before") - F.col(f"_allx_{v}")
            cov = F.sum(n * F.col(f"_c_{v}") + n * dv * dx)
            var = F.sum(n * F.col(f"_vx_{v}") + n * dx * dx)
            out.append(F.when(var > 0, cov / var).alias(f"{v}_slope"))
    return merged.groupBy(*keys).agg(*out)


def _tail_values(value: str, tail_rows: int) -> Column:
    """Known values among the last rows of the whole group, from the last rows of one chunk."""
    kept = F.filter("_tail", lambda row: (row["_r"] + F.col("_after")) <= tail_rows)
    return F.filter(F.transform(kept, lambda row: row[value]), lambda x: x.isNotNull())


def hourly_values(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], max_distinct: int, flag: str, scale: int = 10
) -> DataFrame:
    """Hourly quantities repeated on every row: the mean per hour and a flag when they vary.

    Equal rows are first counted on keys plus values, so an hour with very many rows is reduced on
    the map side or spread by its values; only distinct values reach the group of the hour.
    """
    keys, values = list(keys), list(values)
    counted = df.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("_n"))
    if len(values) == 1:
        distinct = counted.withColumn("_name", F.lit(values[0])).withColumnRenamed(values[0], "_value")
    else:
        pairs = F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).alias("value")) for v in values])
        long = counted.select(*keys, "_n", F.explode(pairs).alias("_p"))
        distinct = long.groupBy(*keys, F.col("_p.name").alias("_name"), F.col("_p.value").alias("_value")).agg(
            F.sum("_n").alias("_n")
        )

    def known(v: str, c: Column) -> Column:
        return F.when((F.col("_name") == v) & F.col("_value").isNotNull(), c)

    # the product must not need more than 38 digits, or Spark would cut decimals off it
    if not 0 <= scale <= 11:
        raise ValueError("a scale of 0 to 11 decimals is summed exactly")
    amount = F.col("_value").cast(f"decimal({16 + scale},{scale})") * F.col("_n").cast("decimal(10,0)")
    means = [F.try_divide(F.sum(known(v, amount)).cast("double"), F.sum(known(v, F.col("_n")))).alias(v) for v in values]
    kinds = [F.count(known(v, F.lit(1))) for v in values]
    worst = F.greatest(*kinds) if len(kinds) > 1 else kinds[0]
    return distinct.groupBy(*keys).agg(*means, (worst > max_distinct).alias(flag))


def lab_hourly(df: DataFrame, keys: Sequence[str], values: Sequence[str], max_distinct: int = 1, scale: int = 10):
    """One lab row per hour; ``lab_is_interpolated`` marks hours with several values."""
    return hourly_values(df, keys, values, max_distinct, "lab_is_interpolated", scale)


def feed_hourly(df: DataFrame, keys: Sequence[str], values: Sequence[str], max_distinct: int = 1, scale: int = 10):
    return hourly_values(df, keys, values, max_distinct, "feed_is_interpolated", scale)


def completeness(df: DataFrame, expected: int, min_pct: float) -> DataFrame:
    """Share of the expected rows, and whether the hour may train a model."""
    pct = F.col("row_count") * 100.0 / F.lit(float(expected))
    return df.withColumn("completeness_pct", pct).withColumn(
        "is_trainable", F.col("completeness_pct") >= F.lit(float(min_pct))
    )
