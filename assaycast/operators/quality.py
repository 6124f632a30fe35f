"""Schema contract, row rules, duplicates, disposition, reconciliation, key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaycast.config import BUSINESS_COLUMNS, CANONICAL, NUMERIC_COLUMNS, RAGGED, Config
from assaycast.functions.columns import in_range, is_blank, parse_decimal, parse_hour


class CheckFailed(RuntimeError):
    """A check that stops the run."""


# ---- DQ01 ---------------------------------------------------------------------------------


def check_contract(columns: Sequence[str], required: Sequence[str]) -> None:
    """Fail the run when a required column is absent or an unknown one appears (names without case)."""
    have = [c.strip().lower() for c in columns]
    want = [c.lower() for c in required]
    missing = [c for c in required if c.lower() not in have]
    unknown = [c for c in columns if c.strip().lower() not in want]
    twice = sorted({c for c in have if have.count(c) > 1})
    if missing or unknown or twice:
        raise CheckFailed(f"DQ01 schema: missing {missing}, unknown {unknown}, repeated {twice}")


def canonicalise(df: DataFrame) -> DataFrame:
    """Raw header names to snake_case; names match without case, other columns stay."""
    names = {raw.lower(): name for raw, name in CANONICAL.items()}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c.strip().lower(), c)) for c in df.columns])


# ---- DQ02, DQ03, DQ05 ---------------------------------------------------------------------


def dq02(raw: Sequence[Column], parsed: Sequence[Column]) -> Column:
    """Some field has text that is not a number."""
    tests = [~is_blank(r) & p.isNull() for r, p in zip(raw, parsed)]
    return reduce(lambda a, b: a | b, tests)


def dq03(hour: Column | str, low: str, high: str) -> Column:
    """The time does not parse or is outside the inclusive dates."""
    c = F.col(hour) if isinstance(hour, str) else hour
    first = F.lit(low).cast("date").cast("timestamp_ntz")
    stop = F.date_add(F.lit(high).cast("date"), 1).cast("timestamp_ntz")
    return F.coalesce((c < first) | (c >= stop), F.lit(True))


def dq05(ranges: dict[str, tuple[float | None, float | None]]) -> Column:
    """Some value is outside its physical limits."""
    tests = [~in_range(c, low, high) for c, (low, high) in ranges.items() if low is not None or high is not None]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def failing_rules(rules: dict[str, Column]) -> Column:
    """Names of the failing rules in rule order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))


def with_disposition(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One fate per distinct row: quarantined by its first failing rule, or kept."""
    out = df.withColumn("failed_rules", failing_rules(rules))
    bad = F.size("failed_rules") > 0
    return out.withColumns(
        {
            "rule_id": F.when(bad, F.col("failed_rules")[0]),
            "dq_status": F.when(bad, F.lit("quarantined")).otherwise(F.lit("ok")),
        }
    )


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("dq_status") == "ok"), df.where(F.col("dq_status") == "quarantined")


# ---- DQ04 ---------------------------------------------------------------------------------


def dedup_keep_first(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], copies: str = "copies"
) -> DataFrame:
    """Keep the first row, by ``order``, of the rows equal in ``columns``; ``copies`` counts them.

    An aggregate with map-side combine, not a window: a row copied very often is reduced before the
    shuffle and never gathers in one task.
    """
    columns, order = list(columns), list(order)
    rest = [c for c in df.columns if c not in columns and c not in order]
    if len(order) == 1 and not rest:
        return df.groupBy(*columns).agg(F.min(order[0]).alias(order[0]), F.count(F.lit(1)).alias(copies))
    kept = df.groupBy(*columns).agg(
        F.min(F.struct(*order, *rest)).alias("_first"), F.count(F.lit(1)).alias(copies)
    )
    return kept.select(*columns, *[F.col(f"_first.{c}").alias(c) for c in order + rest], copies)


# ---- plant rows ---------------------------------------------------------------------------


def parsed_columns() -> dict[str, Column]:
    out = {"hour_ts": parse_hour("hour_ts")}
    out.update({c: parse_decimal(c) for c in NUMERIC_COLUMNS})
    return out


def parse_rows(raw: DataFrame) -> DataFrame:
    """Text rows to typed rows; the text stays beside them as ``raw_<column>``."""
    keep = raw.withColumns({f"raw_{c}": F.col(c) for c in BUSINESS_COLUMNS})
    return keep.withColumns(parsed_columns())


def plant_rules(cfg: Config) -> dict[str, Column]:
    raw = [F.col(f"raw_{c}") for c in NUMERIC_COLUMNS]
    parsed = [F.col(c) for c in NUMERIC_COLUMNS]
    return {
        "DQ02": dq02(raw, parsed),
        "DQ03": dq03("hour_ts", cfg.dq.date_range.min, cfg.dq.date_range.max),
        "DQ05": dq05({c: cfg.range_of(c) for c in NUMERIC_COLUMNS}),
    }


def disposed_rows(bronze: DataFrame, cfg: Config) -> DataFrame:
    """Duplicates out (counted), then one disposition per remaining row.

    A ragged line is a copy only of the same line, and fails DQ01: its values may stand in the wrong columns.
    """
    if RAGGED not in bronze.columns:
        bronze = bronze.withColumn(RAGGED, F.lit(None).cast("string"))
    first = dedup_keep_first(bronze, [*BUSINESS_COLUMNS, RAGGED], ["_source_file", "_row_number"])
    return with_disposition(parse_rows(first), {"DQ01": F.col(RAGGED).isNotNull(), **plant_rules(cfg)})


# ---- results ------------------------------------------------------------------------------


def dq_results(df: DataFrame, rules: Sequence[str], batch: str, copies: str = "copies") -> DataFrame:
    """Rule x batch in one pass: rows checked, failed, passed; DQ04 logs the removed copies."""
    hits = {r: F.count_if(F.array_contains("failed_rules", r)) for r in rules}
    dropped = F.sum(F.col(copies) - 1)
    wide = df.groupBy(F.col(batch).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("_rows"), dropped.alias("_dropped"), *[c.alias(f"_{r}") for r, c in hits.items()]
    )
    lines = [
        F.struct(
            F.lit(r).alias("rule_id"),
            F.col("_rows").alias("rows_checked"),
            F.col(f"_{r}").alias("rows_failed"),
            (F.col(f"_{r}") == 0).alias("passed"),
        )
        for r in rules
    ]
    lines.append(
        F.struct(
            F.lit("DQ04").alias("rule_id"),
            (F.col("_rows") + F.col("_dropped")).alias("rows_checked"),
            F.col("_dropped").alias("rows_failed"),
            F.lit(True).alias("passed"),
        )
    )
    return wide.select("batch_id", F.explode(F.array(*lines)).alias("r")).select("batch_id", "r.*")


def reconcile(bronze_rows: DataFrame, disposed: DataFrame, copies: str = "copies") -> DataFrame:
    """Bronze rows against kept, quarantined and dropped rows: one line with both sides."""
    left = bronze_rows.agg(F.count(F.lit(1)).alias("n"))
    right = disposed.agg(
        F.count_if(F.col("dq_status") == "ok").alias("silver_rows"),
        F.count_if(F.col("dq_status") == "quarantined").alias("quarantined_rows"),
        F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("duplicate_rows"),
    )
    out = right.withColumn("bronze_rows", left.scalar())
    total = F.col("silver_rows") + F.col("quarantined_rows") + F.col("duplicate_rows")
    return out.select(
        "bronze_rows",
        "silver_rows",
        "quarantined_rows",
        "duplicate_rows",
        (total == F.col("bronze_rows")).alias("balanced"),
    )


def assert_reconciled(line: DataFrame) -> None:
    row = line.first()
    if not row["balanced"]:
        raise CheckFailed(f"DQ08 rows do not reconcile: {row.asDict()}")


def freshness_hours(df: DataFrame, hour: str, now: Column) -> DataFrame:
    age = F.floor((F.unix_seconds(now) - F.unix_seconds(F.max(hour).cast("timestamp"))) / 3600)
    return df.agg(F.max(hour).alias("latest_hour"), age.alias("age_hours"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (DQ07, DQ09)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact keys without a dimension row, with their row count (DQ09).

    The fact is reduced to its distinct keys first, so a hot key crosses the join once.
    """
    keys = fact.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


def assert_unique(df: DataFrame, keys: Sequence[str], rule: str) -> None:
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise CheckFailed(f"{rule} keys {list(keys)} not unique, e.g. {[r.asDict() for r in bad]}")


def assert_no_orphans(fact: DataFrame, dim: DataFrame, key: str, rule: str = "DQ09") -> None:
    bad = orphans(fact, dim, key).limit(5).collect()
    if bad:
        raise CheckFailed(f"{rule} {key} without dimension row, e.g. {[r.asDict() for r in bad]}")


def write_guard(df: DataFrame, contract: dict[str, str], constraints: dict[str, Column] | None = None) -> DataFrame:
    """Schema and CHECK enforcement before a write.

    Column names and types must equal ``contract``; a row breaking a constraint makes the write fail
    while it runs, so nothing is read twice.
    """
    have = dict(df.dtypes)
    if have != dict(contract):
        raise CheckFailed(f"schema {have} differs from contract {contract}")
    for name, test in (constraints or {}).items():
        df = df.where(F.when(F.coalesce(test, F.lit(False)), True).otherwise(
            F.raise_error(F.lit(f"constraint {name} violated")).cast("boolean")))
    return df


# ---- comparing builds ---------------------------------------------------------------------


def compare_builds(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that differ between two builds: only in one of them, or with other values."""
    keys = list(keys)
    values = [c for c in a.columns if c not in keys]

    def hashed(df: DataFrame, name: str) -> DataFrame:
        row = F.to_json(F.struct(*values), {"ignoreNullFields": "false"}) if values else F.lit("")
        return df.select(*keys, F.sha2(row, 256).alias(name))

    both = hashed(a, "_a").join(hashed(b, "_b"), keys, "full_outer")
    change = (
        F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").otherwise("changed")
    )
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys, change.alias("difference"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as bags of rows, both ways."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
