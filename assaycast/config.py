"""Typed configuration: paths, checks, features, models and the sizes that bound one task.

``load_config`` reads a YAML (or JSON) file, with the checks and the feature list inside it or in files
of their own. Every missing key keeps the default below.
"""

from __future__ import annotations

import dataclasses
import json
import types
import typing
from dataclasses import dataclass, field
from pathlib import Path

try:
    import yaml
except ImportError:  # JSON files still work
    yaml = None

# ---- fixed values -----------------------------------------------------------------------
FEED_COLUMNS = ["pct_iron_feed", "pct_silica_feed"]
KEY_SENSORS = ["starch_flow", "amina_flow", "ore_pulp_flow", "ore_pulp_ph", "ore_pulp_density"]
AIR_FLOWS = [f"col{i:02d}_air_flow" for i in range(1, 8)]
LEVELS = [f"col{i:02d}_level" for i in range(1, 8)]
LAB_COLUMNS = ["pct_iron_concentrate", "pct_silica_concentrate"]
SENSORS = KEY_SENSORS + AIR_FLOWS + LEVELS
NUMERIC_COLUMNS = FEED_COLUMNS + SENSORS + LAB_COLUMNS
RAW_HEADER = [
    "date", "% Iron Feed", "% Silica Feed", "Starch Flow", "Amina Flow", "Ore Pulp Flow", "Ore Pulp pH", "Ore Pulp Density",
    "Flotation Column 01 Air Flow", "Flotation Column 02 Air Flow", "Flotation Column 03 Air Flow",
    "Flotation Column 04 Air Flow", "Flotation Column 05 Air Flow", "Flotation Column 06 Air Flow",
    "Flotation Column 07 Air Flow", "Flotation Column 01 Level", "Flotation Column 02 Level", "Flotation Column 03 Level",
    "Flotation Column 04 Level", "Flotation Column 05 Level", "Flotation Column 06 Level", "Flotation Column 07 Level",
    "% Iron Concentrate", "% Silica Concentrate",
]
RANGES = {
    "pct_iron_feed": [0, 100],
    "pct_silica_feed": [0, 100],
    "pct_iron_concentrate": [0, 100],
    "pct_silica_concentrate": [0, 100],
    "ore_pulp_ph": [0, 14],
    "ore_pulp_density": [0, 1000],
    "starch_flow": [0, None],
    "amina_flow": [0, None],
    "ore_pulp_flow": [0, None],
    "column_air_flow": [0, None],
    "column_level": [None, None],
}
HOURLY_AGGREGATES = ["mean", "std", "min", "max", "last_15min_mean", "slope"]
STAGES = [
    "ingest_bronze",
    "build_silver",
    "dq_checks",
    "build_gold",
    "train_or_load_model",
    "score_predictions",
    "export_serving",
    "refresh_reports",
]
# -----------------------------------------------------------------------------------------

BUSINESS_COLUMNS = ["hour_ts"] + NUMERIC_COLUMNS
CANONICAL = dict(zip(RAW_HEADER, BUSINESS_COLUMNS))
#: Full text of a line whose number of fields is not that of the header
RAGGED = "_ragged_line"


@dataclass
class Paths:
    raw_csv: str = ""
    warehouse_root: str | None = None
    bronze: str | None = None
    silver: str | None = None
    gold: str | None = None


@dataclass
class Catalog:
    name: str | None = None
    schema_bronze: str | None = None
    schema_silver: str | None = None
    schema_gold: str | None = None


@dataclass
class Postgres:
    host: str | None = None
    host_env: str | None = None
    port: int = 5432
    database: str = ""
    app_rw_user: str = ""
    app_rw_password_env: str = ""
    schema: str = "serving"


@dataclass
class Split:
    train_start: str = "2017-03-01"
    train_end: str = "2017-06-30"
    val_start: str = "2017-07-01"
    val_end: str = "2017-07-31"
    test_start: str = "2017-08-01"
    test_end: str = "2017-09-30"


@dataclass
class Ml:
    lab_delay_hours: int = 1
    off_spec_percentile: int = 75
    shift_starts_hour: int = 6
    split: Split = field(default_factory=Split)
    horizons: list[int] = field(default_factory=lambda: [0, 1, 2, 3, 4])
    folds: int = 3
    fold_days: int = 14
    ridge_reg: list[float] = field(default_factory=lambda: [1.0, 10.0])
    trees: int = 30
    depth: int = 5
    boosting_rounds: int = 20
    quantile_bins: int = 50
    shapley_permutations: int = 10
    retrain: bool = False
    retrain_mae_ratio: float = 1.5
    retrain_psi: float = 0.2
    seed: int = 7


@dataclass
class DateRange:
    min: str = "2017-01-01"
    max: str = "2017-12-31"


@dataclass
class SensorHealth:
    flatline_min_consecutive: int = 30
    flatline_std_threshold: float = 1e-6
    spike_zscore_threshold: float = 4.0
    spike_rolling_window: int = 90


@dataclass
class HourCompleteness:
    expected_rows_per_hour: int = 180
    min_completeness_pct: float = 80.0


@dataclass
class LabValueStability:
    max_distinct_values_per_hour: int = 1


@dataclass
class Quality:
    ranges: dict = field(default_factory=lambda: dict(RANGES))
    date_range: DateRange = field(default_factory=DateRange)
    sensor_health: SensorHealth = field(default_factory=SensorHealth)
    hour_completeness: HourCompleteness = field(default_factory=HourCompleteness)
    lab_value_stability: LabValueStability = field(default_factory=LabValueStability)
    freshness_max_hours: int | None = None
    control_limit_sigmas: float = 3.0


@dataclass
class Features:
    process_sensors: list[str] = field(default_factory=lambda: list(SENSORS))
    hourly_aggregates: list[str] = field(default_factory=lambda: list(HOURLY_AGGREGATES))
    sensor_lag_hours: list[int] = field(default_factory=lambda: [1, 2, 3])
    lab_silica_lag_hours: list[int] = field(default_factory=lambda: [1, 2, 3])
    excluded_features: list[str] = field(default_factory=lambda: ["pct_iron_concentrate"])


@dataclass
class Sizes:
    """Upper bounds on the rows one window group may hold."""

    chunk_rows: int = 500_000
    segment_rows: int = 200_000
    hour_block: int = 2_000


@dataclass
class Config:
    mode: str = "local"
    plant: int = 1
    plant_name: str = "plant-1"
    paths: Paths = field(default_factory=Paths)
    catalog: Catalog = field(default_factory=Catalog)
    postgres: Postgres = field(default_factory=Postgres)
    ml: Ml = field(default_factory=Ml)
    dq: Quality = field(default_factory=Quality)
    features: Features = field(default_factory=Features)
    sizes: Sizes = field(default_factory=Sizes)

    @property
    def is_local(self) -> bool:
        return self.mode == "local"

    def range_of(self, column: str) -> tuple[float | None, float | None]:
        """Physical limits of a column; the seven air flows and levels share one range each."""
        key = column
        if column in AIR_FLOWS:
            key = "column_air_flow"
        elif column in LEVELS:
            key = "column_level"
        low, high = self.dq.ranges.get(key, [None, None])
        return low, high


def _coerce(kind, value):
    if value is None:
        return None
    origin = typing.get_origin(kind)
    if origin in (types.UnionType, typing.Union):
        inner = [a for a in typing.get_args(kind) if a is not type(None)]
        return _coerce(inner[0], value)
    if dataclasses.is_dataclass(kind):
        return _build(kind, value)
    if origin is list:
        (item,) = typing.get_args(kind)
        return [_coerce(item, v) for v in value]
    if kind is dict:
        return {k: [None if b is None else float(b) for b in v] for k, v in value.items()}
    # YAML reads 1e-6 as a string, so numbers are converted here
    return kind(value)


def _build(kind, values: dict):
    hints = typing.get_type_hints(kind)
    known = {k: _coerce(hints[k], v) for k, v in (values or {}).items() if k in hints}
    return kind(**known)


def _read(path: Path) -> dict:
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    if yaml is None:
        raise RuntimeError("PyYAML is needed for YAML files")
    return yaml.safe_load(text) or {}


def load_config(
    path: str | Path, checks: str | Path | None = None, features: str | Path | None = None
) -> Config:
    raw = _read(Path(path))
    for key, side in (("dq", checks), ("features", features)):
        if side is not None:
            raw[key] = _read(Path(side))
    ml = raw.get("ml") or {}
    cfg = _build(Config, raw)
    # the limit may be given under ml or under the checks; the checks win
    dq_hours = (raw.get("dq") or {}).get("hour_completeness") or {}
    if "min_hour_completeness_pct" in ml and "min_completeness_pct" not in dq_hours:
        cfg.dq.hour_completeness.min_completeness_pct = float(ml["min_hour_completeness_pct"])
    return cfg
