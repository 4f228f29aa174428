"""Common table expressions that restate resampling, cleaning and features in DuckDB SQL."""

from __future__ import annotations

from registered.inputs import CLEANING, HZ, SIGNALS, USER_METADATA_SQL, USER_SERIES_SQL

_hz = repr(float(HZ))

GRID = f"""bounds AS (
  SELECT shot_id, min(time_s) AS t_min, max(time_s) AS t_max,
         CAST(round_even((max(time_s) - min(time_s)) * {_hz}::DOUBLE, 0) AS BIGINT) + 1 AS n_grid
  FROM series GROUP BY shot_id),
steps AS (
  SELECT *, CASE WHEN n_grid > 1 THEN (t_max - t_min) / (n_grid - 1) ELSE 0 END AS step
  FROM bounds),
grid AS (
  SELECT shot_id, k, CASE WHEN k = n_grid - 1 AND n_grid > 1 THEN t_max ELSE k * step + t_min END AS x
  FROM (SELECT *, unnest(generate_series(0, n_grid - 1)) AS k FROM steps))"""

POINTS = "points AS (\n" + "\n  UNION ALL ".join(
    f"SELECT shot_id, '{s}' AS signal, {j} AS j, time_s AS t, {s} AS v FROM series WHERE {s} IS NOT NULL"
    for j, s in enumerate(SIGNALS)
) + ")"

RESAMPLED = f"""{GRID},
{POINTS},
wanted AS (
  SELECT g.shot_id, g.k, g.x, s.signal, s.j
  FROM grid g CROSS JOIN (VALUES {", ".join(f"('{s}', {j})" for j, s in enumerate(SIGNALS))}) s(signal, j)),
counted AS (SELECT shot_id, signal, count(*) AS n_valid FROM points GROUP BY ALL),
left_side AS (
  SELECT w.*, p.t AS lt, p.v AS lv FROM wanted w ASOF LEFT JOIN points p
  ON w.shot_id = p.shot_id AND w.signal = p.signal AND w.x >= p.t),
both_sides AS (
  SELECT w.*, p.t AS rt, p.v AS rv FROM left_side w ASOF LEFT JOIN points p
  ON w.shot_id = p.shot_id AND w.signal = p.signal AND w.x < p.t),
resampled AS (
  SELECT b.shot_id, b.k, b.x, b.signal, b.j,
         CASE WHEN coalesce(c.n_valid, 0) < 2 THEN NULL
              WHEN rt IS NULL OR x = lt THEN lv
              WHEN lt IS NULL THEN rv
              ELSE (rv - lv) / (rt - lt) * (x - lt) + lv END AS v
  FROM both_sides b LEFT JOIN counted c USING (shot_id, signal))"""

_reach = CLEANING.mad_window // 2

CLEANED = f"""{RESAMPLED},
medians AS (
  SELECT *, median(v) OVER w AS med, count(v) OVER (PARTITION BY shot_id, signal) AS n_valid
  FROM resampled
  WINDOW w AS (PARTITION BY shot_id, signal ORDER BY k ROWS BETWEEN {_reach} PRECEDING AND {_reach} FOLLOWING)),
mads AS (
  SELECT *, median(abs(v - med)) OVER w AS mad FROM medians
  WINDOW w AS (PARTITION BY shot_id, signal ORDER BY k ROWS BETWEEN {_reach} PRECEDING AND {_reach} FOLLOWING)),
flagged AS (
  SELECT shot_id, signal, j, k, x, v,
         n_valid >= {CLEANING.mad_window} AND coalesce(
           abs(0.6745e0 * (v - med) / (mad + 1e-9)) > {CLEANING.outlier_mad_threshold}, FALSE) AS is_out
  FROM mads),
kept AS (SELECT *, CASE WHEN NOT is_out THEN v END AS kv FROM flagged),
neighbours AS (
  SELECT *, last_value(CASE WHEN kv IS NOT NULL THEN k END IGNORE NULLS) OVER up AS pi,
         last_value(kv IGNORE NULLS) OVER up AS pv,
         first_value(CASE WHEN kv IS NOT NULL THEN k END IGNORE NULLS) OVER down AS ni,
         first_value(kv IGNORE NULLS) OVER down AS nv,
         max(k) OVER (PARTITION BY shot_id, signal) AS last_k
  FROM kept
  WINDOW up AS (PARTITION BY shot_id, signal ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY shot_id, signal ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT shot_id, signal, j, k, x, is_out,
         CASE WHEN kv IS NOT NULL THEN kv
              WHEN coalesce(ni, last_k + 1) - coalesce(pi, -1) - 1 > {CLEANING.max_gap_to_impute} THEN NULL
              WHEN pi IS NULL THEN nv
              WHEN ni IS NULL THEN pv
              ELSE (nv - pv) / (ni - pi) * (k - pi) + pv END AS v
  FROM neighbours),
cleaned AS (
  SELECT shot_id, k, any_value(x) AS time_s,
         {", ".join(f"max(CASE WHEN j = {j} THEN v END) AS {s}" for j, s in enumerate(SIGNALS))},
         CAST(sum(CASE WHEN is_out THEN 1 << j ELSE 0 END) AS INTEGER) AS outlier_mask
  FROM filled GROUP BY shot_id, k)"""

QUALITY = f"""signal_quality AS (
  SELECT shot_id, signal, 1.0e0 - count(*) FILTER (v IS NULL) / CAST(count(*) AS DOUBLE) AS completeness,
         count(*) FILTER (is_out) AS n_outliers
  FROM filled GROUP BY shot_id, signal),
quality AS (
  SELECT *, (c0 + c1 + c2 + c3) / 4 AS overall_completeness FROM (SELECT shot_id,
         {", ".join(f"max(CASE WHEN signal = '{s}' THEN completeness END) AS c{j}, max(CASE WHEN signal = '{s}' THEN n_outliers END) AS o{j}" for j, s in enumerate(SIGNALS))}
  FROM signal_quality GROUP BY shot_id)),
flags AS (
  SELECT *, CASE WHEN overall_completeness >= 0.98 THEN 'OK'
                 WHEN overall_completeness >= 0.90 THEN 'DEGRADED' ELSE 'REJECTED' END AS quality_flag
  FROM quality)"""


def exactly(x: str, digits: int) -> str:
    """Half-even rounding to ``digits`` places on the exact binary value."""
    n = 10**digits
    high = f"(134217729e0 * {x} - (134217729e0 * {x} - {x}))"
    rest = f"(({high} * {2 * n}e0 - (2 * floor({x} * {n}e0) + 1)) + ({x} - {high}) * {2 * n}e0)"
    up = f"{rest} > 0 OR ({rest} = 0 AND floor({x} * {n}e0) % 2 <> 0)"
    return f"(floor({x} * {n}e0) + CASE WHEN {up} THEN 1 ELSE 0 END) / {n}e0"


def _exact(x: str) -> str:
    return exactly(x, 4)


def features_sql(source: str, index: str, rounded=_exact) -> str:
    """Features of a wide table; the lag and the end margin follow from the first time step."""
    return f"""scale AS (
  SELECT shot_id, count(*) AS n, max(time_s) - min(time_s) AS duration, max(plasma_current_MA) AS peak,
         max(CASE WHEN {index} = 1 THEN time_s END) - max(CASE WHEN {index} = 0 THEN time_s END) AS dt
  FROM {source} GROUP BY shot_id),
scaled AS (
  SELECT *, greatest(CAST(trunc(0.05e0 / dt) AS BIGINT), 1) AS lag_rows,
         greatest(CAST(trunc(0.2e0 / dt) AS BIGINT), 1) AS margin_rows FROM scale),
drops AS (
  SELECT a.shot_id, min(a.time_s) AS drop_time
  FROM {source} a JOIN scaled s ON a.shot_id = s.shot_id
  JOIN {source} b ON a.shot_id = b.shot_id AND a.{index} = b.{index} + s.lag_rows
  WHERE s.n >= 10 AND s.peak >= 0.1 AND a.{index} < greatest(s.lag_rows + 1, s.n - s.margin_rows)
    AND b.plasma_current_MA - a.plasma_current_MA > 0.5e0 * s.peak
    AND b.plasma_current_MA > 0.5e0 * s.peak
  GROUP BY a.shot_id),
plateau AS (
  SELECT a.shot_id, avg(plasma_current_MA) AS c, avg(electron_density) AS d, avg(electron_temperature) AS t
  FROM {source} a JOIN scale s ON a.shot_id = s.shot_id
  WHERE s.peak > 0 AND a.plasma_current_MA > 0.7e0 * s.peak GROUP BY a.shot_id),
features AS (
  SELECT shot_id, {rounded('duration')} AS duration_effective_s, n AS n_samples_after_cleaning,
         {rounded('peak')} AS plasma_current_max_MA, {rounded('c')} AS plasma_current_mean_MA,
         {rounded('d')} AS electron_density_mean, {rounded('t')} AS electron_temperature_mean,
         drop_time IS NOT NULL AS disruption_detected, {rounded('drop_time')} AS disruption_time_detected_s
  FROM (SELECT s.shot_id, s.duration, s.n, s.peak, r.drop_time,
               CASE WHEN p.shot_id IS NULL THEN 0e0 ELSE p.c END AS c,
               CASE WHEN p.shot_id IS NULL THEN 0e0 ELSE p.d END AS d,
               CASE WHEN p.shot_id IS NULL THEN 0e0 ELSE p.t END AS t
        FROM scale s LEFT JOIN plateau p USING (shot_id) LEFT JOIN drops r USING (shot_id)))"""


META = f"""{USER_SERIES_SQL},
{CLEANED},
{QUALITY},
{features_sql("cleaned", "k")},
{USER_METADATA_SQL},
meta AS (
  SELECT d.shot_id, d.operator, d.machine_config, d.source_format, d.source_current_unit,
         d.source_column_naming, d.source_sampling_hz, d.declared_disruption,
         d.declared_disruption_time_s, d.declared_duration_s, q.quality_flag,
         {_exact('q.overall_completeness')} AS overall_completeness,
         {_exact('q.c0')} AS completeness_plasma_current, {_exact('q.c1')} AS completeness_density,
         {_exact('q.c2')} AS completeness_temperature, {_exact('q.c3')} AS completeness_vloop,
         q.o0 AS outliers_plasma_current, q.o1 AS outliers_density,
         q.o2 AS outliers_temperature, q.o3 AS outliers_vloop,
         f.* EXCLUDE (shot_id),
         d.source_column_naming || '_' || d.source_current_unit AS schema_applied,
         '1.0.0' AS pipeline_version
  FROM described d JOIN flags q USING (shot_id) JOIN features f USING (shot_id))"""
