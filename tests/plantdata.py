"""Small plant files for tests: known good rows plus rows that break one rule each."""

from __future__ import annotations

import csv
import math
import random
from datetime import datetime, timedelta

from assaycast.config import NUMERIC_COLUMNS, RAW_HEADER, Config, Split


def number(x: float) -> str:
    return f"{x:.4f}".rstrip("0").rstrip(".").replace(".", ",")


def plant_lines(days: int = 20, per_hour: int = 6, seed: int = 3) -> list[list[str]]:
    """Hours with slow random walks; silica follows starch, amina and its own past. Hour 30 is missing."""
    rng = random.Random(seed)
    start = datetime(2017, 3, 1)
    drift = {c: 0.0 for c in NUMERIC_COLUMNS}
    silica = 2.5
    lines = []
    for h in range(days * 24):
        hour = start + timedelta(hours=h)
        for c in drift:
            drift[c] = 0.9 * drift[c] + rng.gauss(0, 0.3)
        silica = 0.6 * silica + 1.0 + 0.4 * drift["starch_flow"] - 0.3 * drift["amina_flow"] + rng.gauss(0, 0.05)
        silica = min(max(silica, 0.5), 6.0)
        iron = 70 - 1.5 * silica
        feed = [55 + drift["pct_iron_feed"], 15 + drift["pct_silica_feed"]]
        if h == 30:
            continue
        for i in range(per_hour):
            row = [hour.strftime("%Y-%m-%d %H:%M:%S")]
            for c in NUMERIC_COLUMNS:
                if c == "pct_iron_feed":
                    row.append(number(feed[0]))
                elif c == "pct_silica_feed":
                    row.append(number(feed[1]))
                elif c == "pct_iron_concentrate":
                    row.append(number(iron))
                elif c == "pct_silica_concentrate":
                    row.append(number(silica + (0.01 * i if h % 40 == 7 else 0.0)))
                elif c == "ore_pulp_ph":
                    row.append(number(9.5 + 0.1 * drift[c] + rng.gauss(0, 0.01)))
                else:
                    row.append(number(500 + 20 * drift[c] + rng.gauss(0, 1) + math.sin(i)))
            lines.append(row)
    return lines


def broken(lines: list[list[str]]) -> list[list[str]]:
    """Bad decimal, bad time, time outside the range, pH too high, negative flow, two exact copies, bad copies."""

    def changed(i: int, column: str, text: str) -> list[str]:
        row = list(lines[i])
        row[0 if column == "date" else 1 + NUMERIC_COLUMNS.index(column)] = text
        return row

    extra = [
        changed(10, "starch_flow", "5x,2"),
        changed(11, "date", "2017-13-40 01:00:00"),
        changed(12, "date", "2018-01-01 00:00:00"),
        changed(13, "ore_pulp_ph", "14,1"),
        changed(14, "amina_flow", "-1"),
        list(lines[20]),
        list(lines[20]),
        changed(15, "starch_flow", "n/a"),
        changed(15, "starch_flow", "n/a"),
    ]
    return lines + extra


def write_csv(path, lines, header=RAW_HEADER) -> str:
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_ALL)
        w.writerow(header)
        w.writerows(lines)
    return str(path)


def plant_config(root, raw: str) -> Config:
    cfg = Config()
    cfg.paths.raw_csv = raw
    cfg.paths.warehouse_root = str(root)
    cfg.dq.hour_completeness.expected_rows_per_hour = 6
    cfg.ml.split = Split("2017-03-01", "2017-03-12", "2017-03-13", "2017-03-15", "2017-03-16", "2017-03-20")
    cfg.ml.horizons = [0, 1]
    cfg.ml.folds, cfg.ml.fold_days = 2, 2
    cfg.ml.ridge_reg = [0.1]
    cfg.ml.trees, cfg.ml.depth, cfg.ml.boosting_rounds, cfg.ml.quantile_bins = 8, 3, 4, 10
    cfg.ml.shapley_permutations = 1
    return cfg
