"""The SQL each query is compared with, over the same tables."""

from __future__ import annotations

READ = """r AS (
  SELECT event_id, ts, date_trunc('hour', ts) AS hour_ts, user_id // 40 AS plant, event_type AS sensor, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

RAW_TEXT = READ + """, t AS (
  SELECT event_id, plant, sensor,
         CASE WHEN k = 57 THEN '2017-13-40 01:00:00' ELSE strftime(hour_ts, '%Y-%m-%d %H:%M:%S') END AS date_text,
         CASE WHEN k = 13 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ',0' END AS value_text,
         strftime(ts, '%Y-%m-%d') AS batch
  FROM r),
ranked AS (
  SELECT *, row_number() OVER g AS rn, count(*) OVER (PARTITION BY plant, sensor, date_text, value_text) AS copies
  FROM t WINDOW g AS (PARTITION BY plant, sensor, date_text, value_text ORDER BY event_id)),
parsed AS (
  SELECT *, TRY_CAST(date_text AS TIMESTAMP) AS hour_ts, TRY_CAST(replace(value_text, ',', '.') AS DOUBLE) AS value
  FROM ranked WHERE rn = 1),
ruled AS (
  SELECT *, value_text <> '' AND value IS NULL AS b2,
         hour_ts IS NULL OR hour_ts < TIMESTAMP '2024-01-01' OR hour_ts >= TIMESTAMP '2024-01-30' AS b3,
         coalesce(value < 0 OR value > 200, false) AS b5
  FROM parsed),
d AS (
  SELECT *, CASE WHEN b2 THEN 'DQ02' WHEN b3 THEN 'DQ03' WHEN b5 THEN 'DQ05' END AS rule_id,
         CASE WHEN b2 OR b3 OR b5 THEN 'quarantined' ELSE 'ok' END AS dq_status,
         concat_ws(',', CASE WHEN b2 THEN 'DQ02' END, CASE WHEN b3 THEN 'DQ03' END, CASE WHEN b5 THEN 'DQ05' END)
           AS failed_rules
  FROM ruled)"""

DQ = RAW_TEXT + """, w AS (
  SELECT batch, count(*) AS n, CAST(sum(copies - 1) AS BIGINT) AS dropped,
         count(*) FILTER (b2) AS n2, count(*) FILTER (b3) AS n3, count(*) FILTER (b5) AS n5
  FROM d GROUP BY batch),
dq AS (
  SELECT batch AS batch_id, 'DQ02' AS rule_id, n AS rows_checked, n2 AS rows_failed, n2 = 0 AS passed FROM w
  UNION ALL SELECT batch, 'DQ03', n, n3, n3 = 0 FROM w
  UNION ALL SELECT batch, 'DQ05', n, n5, n5 = 0 FROM w
  UNION ALL SELECT batch, 'DQ04', n + dropped, dropped, true FROM w)"""

LAB = READ + """, lab AS (
  SELECT plant, hour_ts, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS silica,
         count(DISTINCT value) > 1 AS lab_is_interpolated
  FROM r WHERE sensor = 'purchase' GROUP BY plant, hour_ts),
masked AS (
  SELECT plant, hour_ts, CASE WHEN NOT lab_is_interpolated THEN silica END AS silica FROM lab),
known AS (SELECT * FROM masked WHERE silica IS NOT NULL),
train AS (SELECT * FROM known WHERE hour_ts >= TIMESTAMP '2024-01-01' AND hour_ts < TIMESTAMP '2024-01-19'),
cut AS (SELECT quantile_cont(silica, 0.75) AS threshold FROM train)"""

FEED = """feed AS (
  SELECT plant, hour_ts, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS feed,
         count(DISTINCT value) > 1 AS feed_is_interpolated
  FROM r WHERE sensor = 'signup' GROUP BY plant, hour_ts)"""


def _mean_of(sensor: str) -> str:
    part = f"CASE WHEN sensor = '{sensor}' THEN value END"
    return (
        f"CAST(sum(CAST({part} AS DECIMAL(18,2))) AS DOUBLE) / nullif(count({part}), 0) AS {sensor}_mean"
    )


WIDE = f"""wide AS (
  SELECT plant, hour_ts, count(*) AS row_count, {_mean_of('click')}, {_mean_of('view')}, {_mean_of('error')}
  FROM r GROUP BY plant, hour_ts)"""

PAIRS = LAB + """, ks AS (SELECT CAST(unnest([0, 1, 2, 3, 4]) AS INTEGER) AS horizon_h),
pairs AS (
  SELECT p.plant, p.hour_ts + INTERVAL 1 HOUR AS hour_ts, ks.horizon_h,
         p.hour_ts + INTERVAL 1 HOUR + ks.horizon_h * INTERVAL 1 HOUR AS target_hour,
         p.silica AS predicted, a.silica AS actual
  FROM known p, ks
  LEFT JOIN masked a ON a.plant = p.plant
    AND a.hour_ts = p.hour_ts + INTERVAL 1 HOUR + ks.horizon_h * INTERVAL 1 HOUR)"""

LAGS = LAB + """, lagkeys AS (
  SELECT DISTINCT plant, hour_ts + i * INTERVAL 1 HOUR AS hour_ts FROM known, (SELECT unnest([1, 2, 3]) AS i)),
lags AS (
  SELECT k.plant, k.hour_ts, a.silica AS lab_lag1, b.silica AS lab_lag2, c.silica AS lab_lag3
  FROM lagkeys k
  LEFT JOIN known a ON a.plant = k.plant AND a.hour_ts = k.hour_ts - INTERVAL 1 HOUR
  LEFT JOIN known b ON b.plant = k.plant AND b.hour_ts = k.hour_ts - INTERVAL 2 HOUR
  LEFT JOIN known c ON c.plant = k.plant AND c.hour_ts = k.hour_ts - INTERVAL 3 HOUR),
naive AS (
  SELECT l.plant, l.hour_ts, l.hour_ts AS target_hour, l.lab_lag1 AS persistence,
         (l.lab_lag1 + l.lab_lag2 + l.lab_lag3) / 3 AS predicted, a.silica AS actual
  FROM lags l LEFT JOIN masked a ON a.plant = l.plant AND a.hour_ts = l.hour_ts)"""

def _flags(keys: str) -> str:
    return f"""f0 AS (
  SELECT *, floor(value / 50) AS level, row_number() OVER (PARTITION BY {keys} ORDER BY event_id) AS i FROM r),
f1 AS (
  SELECT *, count(*) OVER w = 6 AND stddev_samp(level) OVER w < 1e-6 AS flat_end
  FROM f0 WINDOW w AS (PARTITION BY {keys} ORDER BY i ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
f2 AS (
  SELECT *, max(CAST(flat_end AS INTEGER)) OVER (
    PARTITION BY {keys} ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) = 1 AS is_flat
  FROM f1),
f3 AS (
  SELECT *, coalesce(count(value) OVER w = 90
    AND abs(value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0) > 4, false) AS is_spike
  FROM f2 WINDOW w AS (PARTITION BY {keys} ORDER BY i ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING))"""


FLAT = _flags("sensor")
FLAT_PLANT = _flags("plant, sensor")

HEALTH = READ + ", " + FLAT_PLANT + """, hc AS (
  SELECT plant, sensor, hour_ts, count(*) AS row_count, count(*) FILTER (is_flat) AS flatline_rows,
         count(*) FILTER (value < 0 OR value > 200) AS out_of_range_rows, count(*) FILTER (is_spike) AS spike_rows
  FROM f3 GROUP BY plant, sensor, hour_ts),
health AS (
  SELECT *, flatline_rows > 0 AS is_flatline, out_of_range_rows > 0 AS is_out_of_range, spike_rows > 0 AS has_spike
  FROM hc)"""

CONTRIB = READ + ", " + WIDE + """, contrib AS (
  SELECT plant, hour_ts, 'click_mean' AS feature, 0.5 * (coalesce(click_mean, 50.0) - 50.0) AS contribution FROM wide
  UNION ALL SELECT plant, hour_ts, 'view_mean', -0.25 * (coalesce(view_mean, 40.0) - 40.0) FROM wide
  UNION ALL SELECT plant, hour_ts, 'error_mean', 1.5 * (coalesce(error_mean, 60.0) - 60.0) FROM wide)"""


def _shift(c: str) -> str:
    return f"substr('ABC', CAST(floor(((hour({c}) - 6 + 24) % 24) / 8) AS INTEGER) + 1, 1)"


def _replicas(n: int) -> str:
    digest = "md5(concat_ws('|', CAST(event_id AS VARCHAR), CAST(c AS VARCHAR), 'value', '7'))"
    unit = f"CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"
    return READ + f""", copies AS (
  SELECT event_id, CASE WHEN c = 0 THEN plant ELSE 1073741824 + plant * {n} + c - 1 END AS plant, sensor, hour_ts + c * INTERVAL 24 HOUR AS hour_ts,
         CASE WHEN c = 0 THEN value ELSE value * (1 + 0.1::DOUBLE * ({unit} - 0.5)) END AS value, c > 0 AS is_synthetic
  FROM r, (SELECT unnest(range(0, {n + 1})) AS c))"""


HOUR_N = """SELECT plant, sensor, hour_ts, value,
    row_number() OVER (PARTITION BY plant, sensor, hour_ts ORDER BY event_id) AS i,
    row_number() OVER (PARTITION BY plant, sensor, hour_ts ORDER BY event_id DESC) AS e FROM r"""

ORACLE: dict[str, str] = {
    "decimal_comma_parse": f"""WITH {READ}, t AS (
  SELECT event_id, CASE WHEN k = 13 THEN 'n/a' WHEN k = 14 THEN ''
    ELSE replace(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS text FROM r)
SELECT event_id, text, TRY_CAST(replace(text, ',', '.') AS DOUBLE) AS parsed,
  text <> '' AND TRY_CAST(replace(text, ',', '.') AS DOUBLE) IS NULL AS is_bad FROM t""",
    "schema_cast_dispositions": f"""WITH {RAW_TEXT}
SELECT event_id, plant, sensor, hour_ts, value, dq_status, rule_id, failed_rules, copies FROM d""",
    "dedup_keep_first": f"""WITH {READ}
SELECT hour_ts, sensor, CAST(floor(value) AS BIGINT) AS level, min(event_id) AS event_id, count(*) AS copies
FROM r GROUP BY ALL""",
    "reconcile_layers": f"""WITH {RAW_TEXT}, s AS (
  SELECT (SELECT count(*) FROM r) AS bronze_rows, count(*) FILTER (dq_status = 'ok') AS silver_rows,
    count(*) FILTER (dq_status = 'quarantined') AS quarantined_rows, CAST(sum(copies - 1) AS BIGINT) AS duplicate_rows
  FROM d)
SELECT *, bronze_rows = silver_rows + quarantined_rows + duplicate_rows AS balanced FROM s""",
    "dq_results": f"WITH {DQ} SELECT * FROM dq",
    "dq_pass_rate": f"""WITH {DQ}
SELECT rule_id, avg(CAST(passed AS DOUBLE)) AS pass_rate, CAST(sum(rows_failed) AS BIGINT) AS rows_failed
FROM dq GROUP BY rule_id""",
    "fact_key_orphans": """SELECT l_partkey, count(*) AS n_rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25) GROUP BY l_partkey""",
    "unique_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "process_hourly": f"""WITH {READ}, n AS ({HOUR_N})
SELECT plant, sensor, hour_ts, count(*) AS row_count, round(avg(value), 8) AS value_mean,
  round(stddev_samp(value), 6) AS value_std, min(value) AS value_min, max(value) AS value_max,
  round(avg(value) FILTER (e <= 5), 8) AS value_last_mean,
  CASE WHEN count(*) > 1 THEN round(regr_slope(value, i), 6) END AS value_slope
FROM n GROUP BY plant, sensor, hour_ts""",
    "last_window_mean_slope": f"""WITH {READ}, n AS (
  SELECT plant, hour_ts, value, row_number() OVER (PARTITION BY plant, hour_ts ORDER BY event_id) AS i,
    row_number() OVER (PARTITION BY plant, hour_ts ORDER BY event_id DESC) AS e FROM r)
SELECT plant, hour_ts, count(*) AS row_count, round(avg(value) FILTER (e <= 3), 8) AS last_mean,
  CASE WHEN count(*) > 1 THEN round(regr_slope(value, i), 6) END AS slope
FROM n GROUP BY plant, hour_ts""",
    "completeness": f"""WITH {READ}
SELECT hour_ts, count(*) AS row_count, round(count(*) * 100.0::DOUBLE / 14, 8) AS completeness_pct,
  count(*) * 100.0::DOUBLE / 14 >= 80 AS is_trainable FROM r GROUP BY hour_ts""",
    "lab_hourly_interpolated": f"WITH {LAB} SELECT * FROM lab",
    "feed_hourly": f"WITH {READ}, {FEED} SELECT * FROM feed",
    "flatline": f"WITH {READ}, {FLAT} SELECT event_id, sensor, hour_ts FROM f2 WHERE is_flat",
    "spike": f"WITH {READ}, {FLAT} SELECT event_id, sensor, hour_ts, value FROM f3 WHERE is_spike",
    "out_of_range": f"""WITH {READ}, dim(sensor, lo, hi) AS (VALUES ('click', 0, 200), ('view', 0, 250),
  ('error', NULL, 150), ('signup', 1, NULL), ('purchase', NULL, NULL))
SELECT event_id, sensor, value FROM r JOIN dim USING (sensor) WHERE value < lo OR value > hi""",
    "sensor_health": f"WITH {HEALTH} SELECT * FROM health",
    "current_issues": f"""WITH {HEALTH}
SELECT plant, hour_ts, sensor, is_flatline, is_out_of_range, has_spike FROM health
WHERE is_flatline OR is_out_of_range OR has_spike""",
    "health_heatmap": f"""WITH {HEALTH}
SELECT sensor, CAST(hour_ts AS DATE) AS day, count(*) FILTER (is_flatline) AS flatline_hours,
  count(*) FILTER (is_out_of_range) AS out_of_range_hours, count(*) FILTER (has_spike) AS spike_hours
FROM health GROUP BY ALL""",
    "hour_confidence": f"""WITH {HEALTH}
SELECT plant, hour_ts, count(*) FILTER (sensor IN ('click', 'view') AND (is_flatline OR is_out_of_range OR has_spike))
  AS bad_key_sensors FROM health GROUP BY plant, hour_ts""",
    "control_chart": f"""WITH {LAB}, c AS (
  SELECT avg(silica) - 2 * stddev_samp(silica) AS lower, avg(silica) + 2 * stddev_samp(silica) AS upper
  FROM lab WHERE hour_ts < TIMESTAMP '2024-01-19')
SELECT plant, hour_ts, silica, round(lower, 6) AS lower, round(upper, 6) AS upper, silica < lower OR silica > upper AS is_breach
FROM lab, c""",
    "gap_islands": f"""WITH {LAB}, n AS (
  SELECT plant, hour_ts, lead(hour_ts) OVER (PARTITION BY plant ORDER BY hour_ts) AS nxt FROM lab)
SELECT plant, hour_ts + INTERVAL 1 HOUR AS gap_start, nxt - INTERVAL 1 HOUR AS gap_end,
  date_diff('hour', hour_ts, nxt) - 1 AS missing_hours FROM n WHERE date_diff('hour', hour_ts, nxt) > 1""",
    "hour_spine": f"""WITH {LAB}, span AS (SELECT plant, min(hour_ts) AS a, max(hour_ts) AS b FROM lab GROUP BY plant),
s AS (SELECT plant, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour_ts FROM span)
SELECT s.plant, s.hour_ts, lab.silica FROM s LEFT JOIN lab ON lab.plant = s.plant AND lab.hour_ts = s.hour_ts""",
    "dim_time_shift": f"""WITH {READ}, h AS (SELECT DISTINCT hour_ts FROM r)
SELECT CAST(strftime(hour_ts, '%Y%m%d%H') AS INTEGER) AS hour_key, hour_ts AS ts, CAST(hour_ts AS DATE) AS date,
  CAST(hour(hour_ts) AS INTEGER) AS hour, {_shift('hour_ts')} AS shift,
  CAST(hour_ts - INTERVAL 6 HOUR AS DATE) AS shift_date, CAST(dayofweek(hour_ts) + 1 AS INTEGER) AS day_of_week,
  CAST(weekofyear(hour_ts) AS INTEGER) AS week, CAST(month(hour_ts) AS INTEGER) AS month FROM h""",
    "upsert_idempotent": f"""WITH {READ}, old AS (
  SELECT plant, hour_ts, count(*) AS n, max(value) AS top FROM r WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ALL),
new AS (
  SELECT plant, hour_ts, count(*) AS n, max(value) AS top FROM r
  WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' AND value > 20 GROUP BY ALL)
SELECT * FROM new UNION ALL
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.plant = old.plant AND new.hour_ts = old.hour_ts)""",
    "compare_builds": f"""WITH {READ}, a AS (
  SELECT plant, hour_ts, count(*) AS n, max(value) AS top FROM r GROUP BY ALL),
b AS (SELECT plant, hour_ts, count(*) AS n, max(value) AS top FROM r WHERE value <= 200 GROUP BY ALL)
SELECT coalesce(a.plant, b.plant) AS plant, coalesce(a.hour_ts, b.hour_ts) AS hour_ts,
  CASE WHEN b.n IS NULL THEN 'only_left' WHEN a.n IS NULL THEN 'only_right' ELSE 'changed' END AS difference
FROM a FULL JOIN b ON a.plant = b.plant AND a.hour_ts = b.hour_ts
WHERE a.n IS DISTINCT FROM b.n OR a.top IS DISTINCT FROM b.top""",
    "merged_snapshot": """WITH s AS (SELECT o_custkey AS c_custkey, max(o_totalprice) AS amount FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_acctbal AS amount FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s)
UNION ALL SELECT * FROM s""",
    "raw_load_dense": """SELECT count(*) AS n_rows, count(*) AS sum_of_last_numbers, CAST(1 AS BIGINT) AS first_number,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events""",
    "sensor_lags": f"""WITH {READ}, {WIDE}
SELECT w.plant, w.hour_ts, w.click_mean, w.view_mean, a.click_mean AS click_mean_lag1, a.view_mean AS view_mean_lag1,
  b.click_mean AS click_mean_lag2, b.view_mean AS view_mean_lag2, c.click_mean AS click_mean_lag3,
  c.view_mean AS view_mean_lag3
FROM wide w
LEFT JOIN wide a ON a.plant = w.plant AND a.hour_ts = w.hour_ts - INTERVAL 1 HOUR
LEFT JOIN wide b ON b.plant = w.plant AND b.hour_ts = w.hour_ts - INTERVAL 2 HOUR
LEFT JOIN wide c ON c.plant = w.plant AND c.hour_ts = w.hour_ts - INTERVAL 3 HOUR""",
    "lab_lags": f"WITH {LAGS} SELECT * FROM lags",
    "horizon_targets": f"""WITH {LAB}, {WIDE}, ks AS (SELECT CAST(unnest([0, 1, 2, 3, 4]) AS INTEGER) AS horizon_h)
SELECT w.plant, k.hour_ts AS target_hour, w.hour_ts, w.click_mean, ks.horizon_h, k.silica AS target
FROM wide w, ks, known k
WHERE k.plant = w.plant AND k.hour_ts = w.hour_ts + ks.horizon_h * INTERVAL 1 HOUR""",
    "persistence_metrics": f"""WITH {PAIRS}
SELECT horizon_h, count(predicted - actual) AS n, round(avg(abs(predicted - actual)), 8) AS mae,
  round(sqrt(avg((predicted - actual) * (predicted - actual))), 8) AS rmse FROM pairs GROUP BY horizon_h""",
    "persistence_skill": f"""WITH {LAGS}, b AS (
  SELECT * FROM naive WHERE predicted IS NOT NULL AND persistence IS NOT NULL AND actual IS NOT NULL)
SELECT count(*) AS n, round(avg(abs(predicted - actual)), 8) AS mae,
  round(sqrt(avg((predicted - actual) * (predicted - actual))), 8) AS rmse,
  round(avg(abs(persistence - actual)), 8) AS persistence_mae,
  round(1 - avg(abs(predicted - actual)) / avg(abs(persistence - actual)), 8) AS skill FROM b""",
    "lab_asof": f"""WITH {LAB}, span AS (SELECT plant, min(hour_ts) AS a, max(hour_ts) AS b FROM r GROUP BY plant),
s AS (SELECT plant, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour_ts FROM span),
v AS (SELECT plant, hour_ts + INTERVAL 1 HOUR AS seen, silica, hour_ts AS lab_hour FROM known)
SELECT s.plant, s.hour_ts, v.silica AS lab_value, v.lab_hour
FROM s ASOF LEFT JOIN v ON v.plant = s.plant AND s.hour_ts >= v.seen""",
    "assembled_features": f"""WITH {LAGS}, {WIDE}, {FEED}
SELECT w.plant, w.hour_ts, w.click_mean, w.view_mean, w.error_mean,
  a.click_mean AS click_mean_lag1, a.view_mean AS view_mean_lag1, a.error_mean AS error_mean_lag1,
  b.click_mean AS click_mean_lag2, b.view_mean AS view_mean_lag2, b.error_mean AS error_mean_lag2,
  c.click_mean AS click_mean_lag3, c.view_mean AS view_mean_lag3, c.error_mean AS error_mean_lag3,
  f.feed, l.lab_lag1, l.lab_lag2, l.lab_lag3, CAST(hour(w.hour_ts) AS INTEGER) AS hour_of_day,
  CAST(floor(((hour(w.hour_ts) - 6 + 24) % 24) / 8) AS INTEGER) AS shift_no
FROM wide w
LEFT JOIN wide a ON a.plant = w.plant AND a.hour_ts = w.hour_ts - INTERVAL 1 HOUR
LEFT JOIN wide b ON b.plant = w.plant AND b.hour_ts = w.hour_ts - INTERVAL 2 HOUR
LEFT JOIN wide c ON c.plant = w.plant AND c.hour_ts = w.hour_ts - INTERVAL 3 HOUR
LEFT JOIN feed f ON f.plant = w.plant AND f.hour_ts = w.hour_ts
LEFT JOIN lags l ON l.plant = w.plant AND l.hour_ts = w.hour_ts""",
    "walk_forward_folds": f"""WITH {LAB}, folds(fold, cut_at, stop_at) AS (VALUES
  (0, TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-14'), (1, TIMESTAMP '2024-01-14', TIMESTAMP '2024-01-18'),
  (2, TIMESTAMP '2024-01-18', TIMESTAMP '2024-01-22'))
SELECT fold, CASE WHEN hour_ts < cut_at THEN 'train' ELSE 'val' END AS role, count(*) AS n, max(hour_ts) AS last_hour
FROM lab, folds WHERE hour_ts < stop_at GROUP BY ALL""",
    "time_split": """SELECT CASE WHEN ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-19' THEN 'train'
  WHEN ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-24' THEN 'val'
  WHEN ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-02-01' THEN 'test' END AS split, count(*) AS n
FROM events GROUP BY 1""",
    "training_hours": f"""WITH {LAB}, {WIDE}
SELECT plant, hour_ts, silica, lab_is_interpolated FROM lab WHERE EXISTS (
  SELECT 1 FROM wide w WHERE w.plant = lab.plant AND w.hour_ts = lab.hour_ts AND w.row_count * 100.0 / 4 >= 80)""",
    "plant_replicas": f"""WITH {_replicas(3)}
SELECT event_id, plant, sensor, hour_ts, round(value, 8) AS value, is_synthetic FROM copies""",
    "replica_hourly": f"""WITH {_replicas(2)}
SELECT plant, is_synthetic, hour_ts, count(*) AS row_count, round(avg(value), 8) AS value_mean
FROM copies GROUP BY ALL""",
    "off_spec_threshold": f"WITH {LAB} SELECT round(threshold, 9) AS threshold FROM cut",
    "sensor_quantiles": f"""WITH {READ}
SELECT sensor, round(quantile_cont(value, 0.05), 9) AS p05, round(quantile_cont(value, 0.5), 9) AS p50,
  round(quantile_cont(value, 0.95), 9) AS p95 FROM r GROUP BY sensor""",
    "off_spec_by_shift": f"""WITH {LAB}
SELECT plant, {_shift('hour_ts')} AS shift, count(*) AS n_hours, count(*) FILTER (silica > threshold) AS off_spec_hours,
  count(*) FILTER (silica > threshold) / count(*) AS off_spec_rate FROM known, cut GROUP BY ALL""",
    "shift_comparison": f"""WITH {LAB}
SELECT {_shift('hour_ts')} AS shift, count(*) AS n_hours, count(*) FILTER (silica > threshold) AS off_spec_hours,
  count(*) FILTER (silica > threshold) / count(*) AS off_spec_rate,
  CAST(sum(CAST(silica AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_value FROM known, cut GROUP BY ALL""",
    "off_spec_pr": f"""WITH {PAIRS}, c AS (
  SELECT count(*) FILTER (predicted > threshold AND actual > threshold) AS tp,
    count(*) FILTER (predicted > threshold AND actual <= threshold) AS fp,
    count(*) FILTER (predicted <= threshold AND actual > threshold) AS fn
  FROM pairs, cut WHERE horizon_h = 0)
SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall FROM c""",
    "coverage": f"""WITH {PAIRS}, b AS (
  SELECT * FROM pairs WHERE horizon_h = 0 AND actual IS NOT NULL),
w AS (SELECT quantile_cont(abs(predicted - actual), 0.8) AS width FROM b
  WHERE target_hour >= TIMESTAMP '2024-01-19' AND target_hour < TIMESTAMP '2024-01-24')
SELECT count(*) AS n, count(*) FILTER (actual BETWEEN predicted - width AND predicted + width) AS n_inside,
  count(*) FILTER (actual BETWEEN predicted - width AND predicted + width) / count(*) AS coverage
FROM b, w WHERE target_hour >= TIMESTAMP '2024-01-24' AND target_hour < TIMESTAMP '2024-02-01'""",
    "psi": f"""WITH {READ}, lab AS (
  SELECT sensor, value, CASE WHEN ts < TIMESTAMP '2024-01-19' THEN 1 WHEN ts >= TIMESTAMP '2024-01-24' THEN 0 END AS t
  FROM r),
e AS (SELECT sensor, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
  FROM lab WHERE t = 1 GROUP BY sensor),
b AS (
  SELECT sensor, len(list_filter(edges, lambda x: x < value)) AS bin, count(*) FILTER (t = 1) AS p,
    count(*) FILTER (t = 0) AS q
  FROM lab JOIN e USING (sensor) WHERE t IS NOT NULL GROUP BY ALL),
s AS (
  SELECT sensor, greatest(p / sum(p) OVER (PARTITION BY sensor), 0.0001) AS p,
    greatest(q / sum(q) OVER (PARTITION BY sensor), 0.0001) AS q FROM b)
SELECT sensor, round(sum((p - q) * ln(p / q)), 8) AS psi FROM s GROUP BY sensor""",
    "rolling_mae": f"""WITH {PAIRS}, b AS (SELECT * FROM pairs WHERE horizon_h = 0 AND actual IS NOT NULL)
SELECT plant, target_hour, round(avg(abs(predicted - actual)) OVER w, 8) AS rolling_mae, count(*) OVER w AS n_hours
FROM b WINDOW w AS (PARTITION BY plant ORDER BY target_hour
  RANGE BETWEEN INTERVAL 167 HOUR PRECEDING AND CURRENT ROW)""",
    "iron_corr": f"""WITH {LAB}, {FEED}
SELECT plant, round(corr(silica, feed), 8) AS correlation, count(*) AS n
FROM lab JOIN feed USING (plant, hour_ts) GROUP BY plant""",
    "profile_rows_per_hour": f"""WITH {READ}, h AS (SELECT plant, hour_ts, count(*) AS rows_in_hour FROM r GROUP BY ALL)
SELECT rows_in_hour, count(*) AS n_hours FROM h GROUP BY rows_in_hour""",
    "profile_distinct": f"""WITH {READ}, h AS (
  SELECT sensor, hour_ts, count(DISTINCT floor(value)) AS distinct_values FROM r GROUP BY ALL)
SELECT distinct_values, count(*) AS n_hours FROM h GROUP BY distinct_values""",
    "drivers_topk": f"""WITH {CONTRIB}, k AS (
  SELECT *, row_number() OVER (PARTITION BY plant, hour_ts ORDER BY abs(contribution) DESC, feature) AS i FROM contrib)
SELECT plant, hour_ts, max(feature) FILTER (i = 1) AS top_driver_1, max(feature) FILTER (i = 2) AS top_driver_2,
  max(feature) FILTER (i = 3) AS top_driver_3 FROM k GROUP BY plant, hour_ts""",
    "global_importance": f"""WITH {CONTRIB}
SELECT feature, round(avg(abs(contribution)), 8) AS importance FROM contrib GROUP BY feature""",
    "trends": f"""WITH {LAGS}
SELECT plant, target_hour, round(predicted, 8) AS predicted, actual, persistence, actual > threshold AS is_off_spec,
  {_shift('target_hour')} AS shift
FROM naive, cut WHERE target_hour >= TIMESTAMP '2024-01-05' AND target_hour < TIMESTAMP '2024-01-26'
  AND {_shift('target_hour')} = 'B'""",
    "replay_as_of": f"""WITH {PAIRS}
SELECT plant, hour_ts, target_hour, predicted,
  CASE WHEN target_hour + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-20 10:00:00' THEN actual END AS actual
FROM pairs WHERE horizon_h = 0 AND hour_ts <= TIMESTAMP '2024-01-20 10:00:00'""",
    "quality_now": f"""WITH {LAB}, {FLAT_PLANT}, hc AS (
  SELECT plant, hour_ts, count(DISTINCT sensor) FILTER (sensor IN ('click', 'view')
    AND (is_flat OR is_spike OR value < 0 OR value > 200)) AS bad FROM f3 GROUP BY plant, hour_ts),
p AS (SELECT plant, max(hour_ts) AS h, arg_max(silica, hour_ts) AS predicted FROM known GROUP BY plant)
SELECT p.plant, h + INTERVAL 1 HOUR AS hour_ts, predicted, predicted AS lab_value, h AS lab_hour,
  CASE WHEN coalesce(bad, 1) > 0 THEN 'reduced' ELSE 'normal' END AS confidence, predicted > threshold AS pred_off_spec
FROM p CROSS JOIN cut LEFT JOIN hc ON hc.plant = p.plant AND hc.hour_ts = h + INTERVAL 1 HOUR""",
    "reagent_view": f"""WITH {LAB}, {WIDE}
SELECT plant, hour_ts, click_mean, silica FROM wide JOIN known USING (plant, hour_ts)""",
    "replay_stream_hourly": f"""WITH {READ}
SELECT sensor, hour_ts, count(*) AS row_count, CAST(sum(CAST(value AS DECIMAL(20,2))) AS DOUBLE) / count(*) AS value_mean,
  min(value) AS value_min, max(value) AS value_max, round(stddev_samp(value), 6) AS value_std
FROM r GROUP BY sensor, hour_ts
HAVING hour_ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "stream_dedup": f"WITH {READ} SELECT DISTINCT hour_ts, sensor, CAST(floor(value) AS BIGINT) AS level FROM r",
    "stream_join_labs": f"""WITH {READ}, p AS (
  SELECT plant, hour_ts, max(value) AS predicted FROM r WHERE sensor = 'error' GROUP BY ALL),
l AS (SELECT plant, hour_ts, max(value) AS actual FROM r WHERE sensor = 'purchase' GROUP BY ALL),
w AS (SELECT least(max(ts) FILTER (sensor = 'error'), max(ts) FILTER (sensor = 'purchase')) - INTERVAL 1 HOUR AS mark FROM r)
SELECT plant, hour_ts, predicted, actual FROM p JOIN l USING (plant, hour_ts), w
WHERE hour_ts + INTERVAL 1 HOUR <= mark""",
}
