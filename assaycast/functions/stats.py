"""Exact percentiles without collecting a group into one buffer."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assaycast.sources.tables import cut_lineage

#: Groups whose open bins rows look up in one map; more groups are joined, and their table's size decides how.
LOOKUP_GROUPS = 256
_MANTISSA, _LEAST, _MOST = 2.0**52, -1022, 1023


def ordered_key(value: Column) -> Column:
    """A 64-bit number that orders as the double does: infinities at the ends, NaN last, both zeros alike.

    Exponent and mantissa are taken apart by exact divisions; the logarithm only guesses the exponent.
    """
    size = F.abs(value)
    guess = F.greatest(F.lit(_LEAST), F.least(F.lit(_MOST), F.coalesce(F.floor(F.log2(size)), F.lit(_LEAST)))).cast("double")
    unit = F.pow(F.lit(2.0), guess)
    down = (size < unit) & (guess > _LEAST)
    up = (size / 2 >= unit) & (guess < _MOST)
    exponent = F.when(down, guess - 1).when(up, guess + 1).otherwise(guess)
    unit = F.when(down, unit / 2).when(up, unit * 2).otherwise(unit)
    finite = (exponent - _LEAST).cast("long") * F.lit(1 << 52) + (size / unit * _MANTISSA).cast("long")
    top = F.lit(2047 << 52)
    key = F.when(F.isnan(value), top + 1).when(size == float("inf"), top).otherwise(finite)
    return F.when(value < 0, -key).otherwise(key)


def _locate(bins: Column, target: Column, step: int | None) -> Column:
    """The bin of the target's rank among the bins inside its present one (``step`` bits wider; None: all)."""
    inside = bins if step is None else F.filter(bins, lambda x: F.shiftright(x["bin"], step) == target["bin"])
    nothing = F.struct(
        target["rank"].alias("rank"), F.lit(None).cast("long").alias("bin"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
    )

    def take(acc: Column, x: Column) -> Column:
        here = F.struct(acc["rank"].alias("rank"), x["bin"].alias("bin"), x["lo"].alias("lo"), x["hi"].alias("hi"))
        past = F.struct((acc["rank"] - x["c"]).alias("rank"), acc["bin"].alias("bin"), acc["lo"].alias("lo"), acc["hi"].alias("hi"))
        return F.when(acc["bin"].isNotNull(), acc).when(acc["rank"] < x["c"], here).otherwise(past)

    return F.aggregate(inside, nothing, take)


def _unsettled(t: Column) -> Column:
    return t["lo"] != t["hi"]


def _in_open_bins(clean: DataFrame, state: DataFrame, n_open: int, keys: list[str], shift: int) -> DataFrame:
    """Rows in the bins that hold an unsettled rank of their group."""
    bins = F.array_distinct(F.transform(F.filter("_targets", _unsettled), lambda t: t["bin"])).alias("_open")
    state = state.select(F.struct(F.lit(0), *keys).alias("_group"), bins).where(F.size("_open") > 0)
    group = F.struct(F.lit(0), *keys)
    if n_open <= LOOKUP_GROUPS:
        table = state.agg(F.map_from_entries(F.collect_list(F.struct("_group", "_open")))).scalar()
        met = clean.withColumn("_open", F.try_element_at(table, group))
    else:
        met = clean.join(state, group.eqNullSafe(F.col("_group")))
    return met.where(F.array_contains("_open", F.shiftright("_k", shift)))


def exact_percentiles(
    df: DataFrame, value: str, shares: dict[str, float], keys: Sequence[str] = (), accuracy: int = 65_536
) -> DataFrame:
    """Linear-interpolated percentiles, one output column per entry of ``shares``.

    Ranks are selected by refinement. A round counts the values by the next bits (``accuracy`` bins) of an
    order-preserving 64-bit key, only inside the bins that hold a wanted rank, and each rank goes on in the bin it
    falls into. A rank is settled once its bin holds a single value: after two rounds for readings of a few
    decimals, after 64 bits in any case. Rows are counted where they lie, so only bins are shuffled, and a group's
    bins of a round are at most ``accuracy`` for each open bin, whatever the number of its rows.

    Runs at the call, one job a round. Null values do not count; NaN is the largest value; null keys are a group;
    a group without values has no row, and without ``keys`` there is always one row.
    """
    if accuracy < 2:
        raise ValueError("a round needs two bins or more")
    keys, names = list(keys), list(shares)
    bits = min(24, math.ceil(math.log2(accuracy)))
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    clean = rows.withColumn("_k", ordered_key(F.col("_v")))
    state, n_open, last, shift = None, 1, None, 64
    while shift and n_open:
        last, shift = shift, max(0, shift - bits)
        part = clean if state is None else _in_open_bins(clean, state, n_open, keys, last)
        counts = part.groupBy(*keys, F.shiftright("_k", shift).alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
        )
        found = counts.groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct("bin", "c", "lo", "hi"))).alias("_bins"), F.sum("c").alias("_n")
        )
        if state is None:
            ranks = [f(F.lit(float(q)) * (F.col("_n") - 1)) for q in shares.values() for f in (F.floor, F.ceil)]
            targets = F.transform(F.array(*ranks), lambda r: _locate(F.col("_bins"), F.struct(r.alias("rank")), None))
            state = found.select(*keys, "_n", targets.alias("_targets"))
        else:
            both = state.withColumn("_bins", F.lit(None).cast(found.schema["_bins"].dataType)).unionByName(
                found.withColumn("_n", F.lit(None).cast("long")), allowMissingColumns=True
            )
            met = both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_n", "_targets", "_bins")])
            step = last - shift
            refined = F.transform("_targets", lambda t: F.when(_unsettled(t), _locate(F.col("_bins"), t, step)).otherwise(t))
            state = met.select(*keys, "_n", refined.alias("_targets"))
        seen = Observation()
        state = cut_lineage(state.observe(seen, F.count_if(F.exists("_targets", _unsettled)).alias("open")), "ranks")
        n_open = seen.get["open"]
    points = []
    for i, (name, q) in enumerate(zip(names, shares.values())):
        low, high = F.col("_targets")[2 * i]["lo"], F.col("_targets")[2 * i + 1]["lo"]
        rank = F.lit(float(q)) * (F.col("_n") - 1)
        points.append(F.when(low == high, low).otherwise(low + (high - low) * (rank - F.floor(rank))).alias(name))
    return state.select(*keys, *points)


def exact_percentile(df: DataFrame, value: str, share: float, name: str = "percentile") -> DataFrame:
    return exact_percentiles(df, value, {name: share})
