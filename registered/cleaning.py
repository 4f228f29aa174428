from __future__ import annotations

from pyspark.sql import functions as F

from registered.inputs import (
    CLEANING, HZ, SHOT, SIGNALS, TYPE_SERIES_SQL, USER_SERIES_SQL, cleaned_users, rounded,
    table, type_series, user_series,
)
from registered.sql import CLEANED, GRID, QUALITY, RESAMPLED, _exact
from tidegrid.operators.impute import gap_islands, impute_short_gaps
from tidegrid.operators.outliers import detect_outliers, nullify_outliers, rolling_mad
from tidegrid.operators.quality import quality_report, quality_summary, signal_quality
from tidegrid.operators.resample import grid_bounds, resample_to_grid
from tidegrid.operators.series import with_row_index

TYPE, ORDER = ["event_type"], ["ts", "event_id"]
_FRAME = "(PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING)"
_MAD_SQL = f"""WITH {TYPE_SERIES_SQL},
m AS (SELECT *, median(v) OVER {_FRAME} AS local_median,
             count(v) OVER (PARTITION BY event_type) AS n_valid FROM series),
d AS (SELECT *, median(abs(v - local_median)) OVER {_FRAME} AS local_mad FROM m),
z AS (SELECT *, n_valid >= 101 AND coalesce(
        abs(0.6745e0 * (v - local_median) / (local_mad + 1e-9)) > 6, FALSE) AS is_outlier FROM d)"""
_ROUNDED_SIGNALS = ", ".join(f"round({s}, 6) AS {s}" for s in SIGNALS)
_CLEANED_SQL = f"""WITH {USER_SERIES_SQL}, {CLEANED}
SELECT shot_id, k, time_s, {_ROUNDED_SIGNALS}, outlier_mask FROM cleaned"""
_RESAMPLED_SQL = f"""WITH {USER_SERIES_SQL}, {RESAMPLED}
SELECT shot_id, k, any_value(x) AS time_s,
       {", ".join(f"round(max(CASE WHEN j = {j} THEN v END), 6) AS {s}" for j, s in enumerate(SIGNALS))}
FROM resampled GROUP BY shot_id, k"""


def _rolling(spark, sf_dir, **options):
    return rolling_mad(type_series(spark, sf_dir), TYPE, ORDER, "v", **options)


def _flags(spark, sf_dir, **options):
    return detect_outliers(type_series(spark, sf_dir), TYPE, ORDER, "v", **options)


def _resample(spark, sf_dir, **options):
    out = resample_to_grid(
        user_series(spark, sf_dir), SHOT, "time_s", SIGNALS, HZ, tie=["event_id"], **options
    )
    return rounded(out.withColumnRenamed("_k", "k"))


def _clean(spark, sf_dir, **changes):
    out = cleaned_users(spark, sf_dir, **changes)
    return rounded(out.withColumnRenamed("_k", "k").drop("_b"))


def row_order(spark, sf_dir):
    """Sort by time and renumber, with the series cut into small blocks."""
    return with_row_index(type_series(spark, sf_dir), TYPE, ORDER, split_rows=100).select(
        "event_type", "event_id", F.col("_i").alias("row_index")
    )


def _odd_order():
    """Missing, infinite and repeated order values."""
    e = F.col("event_id")
    return F.when(e % 10 == 0, F.lit(None)).when(e % 97 == 1, float("inf")).when(e % 89 == 2, float("-inf")).otherwise(
        F.floor(F.col("value"))
    )


def row_order_odd(spark, sf_dir):
    """Numbers of rows whose order column has no even scale, with the series cut into blocks."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", _odd_order().alias("at"))
    numbered = with_row_index(events, TYPE, ["at", "event_id"], split_rows=100)
    return numbered.select("event_type", "event_id", F.col("_i").alias("row_index"))


def quality_maps(spark, sf_dir):
    """The exported report: maps per signal with rounded completeness."""
    report = quality_report(user_series(spark, sf_dir), cleaned_users(spark, sf_dir), SHOT, CLEANING, rounded=True)
    return report.select(
        "shot_id", "overall_completeness", F.explode("completeness_per_signal").alias("signal", "completeness"),
        "outliers_per_signal",
    ).select(
        "shot_id", "overall_completeness", "signal", "completeness",
        F.element_at("outliers_per_signal", F.col("signal")).alias("n_outliers"),
    )


def grid(spark, sf_dir):
    return rounded(grid_bounds(user_series(spark, sf_dir), SHOT, "time_s", HZ))


def rolling_median(spark, sf_dir):
    return rounded(_rolling(spark, sf_dir).select("event_id", "local_median"))


def rolling_mad_query(spark, sf_dir):
    return rounded(_rolling(spark, sf_dir).select("event_id", "local_median", "local_mad"))


def rolling_mad_sql_engine(spark, sf_dir):
    out = _rolling(spark, sf_dir, engine="sql", block_rows=1024)
    return rounded(out.select("event_id", "local_median", "local_mad"))


def mad_outliers(spark, sf_dir):
    return _flags(spark, sf_dir).select("event_type", "event_id", "v", "is_outlier")


def mad_outliers_removed(spark, sf_dir):
    removed = nullify_outliers(_flags(spark, sf_dir, split_rows=200, block_rows=256), "v")
    return removed.groupBy("event_type").agg(
        F.count_if("is_outlier").alias("n_outliers"),
        F.count("v").alias("n_valid"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def mad_guard(spark, sf_dir):
    """User series are shorter than the window, so none of their rows may be flagged."""
    flagged = detect_outliers(
        user_series(spark, sf_dir), SHOT, ["time_s", "event_id"], "electron_density", threshold=0.5
    )
    return flagged.groupBy("shot_id").agg(
        F.count_if("is_outlier").alias("n_outliers"), F.count(F.lit(1)).alias("n_rows")
    )


def islands(spark, sf_dir):
    return gap_islands(type_series(spark, sf_dir), TYPE, ORDER, "v", max_gap=5, block_rows=64)


def impute(spark, sf_dir):
    filled = impute_short_gaps(type_series(spark, sf_dir), TYPE, ORDER, ["v"], max_gap=5)
    return rounded(filled.select("event_type", "event_id", "v"))


def quality_by_signal(spark, sf_dir):
    return rounded(signal_quality(cleaned_users(spark, sf_dir), SHOT, SIGNALS))


def _report(spark, sf_dir):
    raw = user_series(spark, sf_dir)
    return quality_report(raw, cleaned_users(spark, sf_dir), SHOT, CLEANING)


def quality_flags(spark, sf_dir):
    return rounded(
        _report(spark, sf_dir).select(
            "shot_id", "n_points_before", "n_points_after", "overall_completeness", "quality_flag"
        )
    )


def summary(spark, sf_dir):
    return rounded(quality_summary(_report(spark, sf_dir)))


QUERIES = {
    "ts_row_order_odd": row_order_odd,
    "ts_quality_maps": quality_maps,
    "ts_row_order": row_order,
    "ts_grid_bounds": grid,
    "ts_resample_linear": _resample,
    "ts_resample_split": lambda spark, sf_dir: _resample(spark, sf_dir, split_rows=8, block_rows=32),
    "ts_rolling_median": rolling_median,
    "ts_rolling_mad": rolling_mad_query,
    "ts_rolling_mad_sql_engine": rolling_mad_sql_engine,
    "ts_mad_outliers": mad_outliers,
    "ts_mad_outliers_removed": mad_outliers_removed,
    "ts_mad_guard": mad_guard,
    "ts_gap_islands": islands,
    "ts_impute_short_gaps": impute,
    "ts_clean_series": _clean,
    "ts_clean_series_sql_engine": lambda spark, sf_dir: _clean(spark, sf_dir, engine="sql"),
    "ts_clean_series_split": lambda spark, sf_dir: _clean(
        spark, sf_dir, split_rows=8, block_rows=48
    ),
    "ts_quality_report": quality_by_signal,
    "ts_quality_flag": quality_flags,
    "ts_quality_summary": summary,
}

_GAPS = f"""WITH {TYPE_SERIES_SQL},
i AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM series),
g AS (SELECT *, i - row_number() OVER (PARTITION BY event_type ORDER BY i) AS run FROM i WHERE v IS NULL)"""

ORACLES = {
    "ts_row_order_odd": """SELECT event_type, event_id, row_number() OVER (
  PARTITION BY event_type ORDER BY CASE WHEN event_id % 10 = 0 THEN NULL
    WHEN event_id % 97 = 1 THEN CAST('inf' AS DOUBLE) WHEN event_id % 89 = 2 THEN CAST('-inf' AS DOUBLE)
    ELSE floor(value) END NULLS FIRST, event_id) - 1 AS row_index FROM events""",
    "ts_quality_maps": f"""WITH {USER_SERIES_SQL}, {CLEANED}, {QUALITY}
SELECT s.shot_id, {_exact('f.overall_completeness')} AS overall_completeness, s.signal,
       {_exact('s.completeness')} AS completeness, s.n_outliers
FROM signal_quality s JOIN flags f USING (shot_id)""",
    "ts_row_order": """SELECT event_type, event_id,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_index FROM events""",
    "ts_grid_bounds": f"""WITH {USER_SERIES_SQL}, {GRID}
SELECT shot_id, round(t_min, 6) AS t_min, round(t_max, 6) AS t_max, n_grid FROM bounds""",
    "ts_resample_linear": _RESAMPLED_SQL,
    "ts_resample_split": _RESAMPLED_SQL,
    "ts_rolling_median": _MAD_SQL + " SELECT event_id, round(local_median, 6) AS local_median FROM z",
    "ts_rolling_mad": _MAD_SQL
    + " SELECT event_id, round(local_median, 6) AS local_median, round(local_mad, 6) AS local_mad FROM z",
    "ts_rolling_mad_sql_engine": _MAD_SQL
    + " SELECT event_id, round(local_median, 6) AS local_median, round(local_mad, 6) AS local_mad FROM z",
    "ts_mad_outliers": _MAD_SQL + " SELECT event_type, event_id, v, is_outlier FROM z",
    "ts_mad_outliers_removed": _MAD_SQL
    + """ SELECT event_type, count(*) FILTER (is_outlier) AS n_outliers,
  count(v) FILTER (NOT is_outlier) AS n_valid, count(*) AS n_rows FROM z GROUP BY event_type""",
    "ts_mad_guard": """SELECT user_id AS shot_id, CAST(0 AS BIGINT) AS n_outliers, count(*) AS n_rows
FROM events GROUP BY user_id""",
    "ts_gap_islands": _GAPS
    + """ SELECT event_type, min(i) AS gap_start, max(i) AS gap_end, count(*) AS gap_rows,
  count(*) <= 5 AS is_short FROM g GROUP BY event_type, run""",
    "ts_impute_short_gaps": f"""WITH {TYPE_SERIES_SQL},
i AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i,
             count(*) OVER (PARTITION BY event_type) AS n FROM series),
w AS (SELECT *, CASE WHEN v IS NOT NULL THEN i END AS vi FROM i),
b AS (SELECT *, last_value(vi IGNORE NULLS) OVER up AS pi, last_value(v IGNORE NULLS) OVER up AS pv,
             first_value(vi IGNORE NULLS) OVER down AS ni, first_value(v IGNORE NULLS) OVER down AS nv FROM w
      WINDOW up AS (PARTITION BY event_type ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             down AS (PARTITION BY event_type ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_type, event_id, round(CASE WHEN v IS NOT NULL THEN v
    WHEN coalesce(ni, n) - coalesce(pi, -1) - 1 > 5 THEN NULL
    WHEN pi IS NULL THEN nv WHEN ni IS NULL THEN pv
    ELSE (nv - pv) / (ni - pi) * (i - pi) + pv END, 6) AS v FROM b""",
    "ts_clean_series": _CLEANED_SQL,
    "ts_clean_series_sql_engine": _CLEANED_SQL,
    "ts_clean_series_split": _CLEANED_SQL,
    "ts_quality_report": f"""WITH {USER_SERIES_SQL}, {CLEANED}, {QUALITY}
SELECT shot_id, signal, round(completeness, 6) AS completeness, n_outliers FROM signal_quality""",
    "ts_quality_flag": f"""WITH {USER_SERIES_SQL}, {CLEANED}, {QUALITY}
SELECT shot_id, n_points_before, n_grid AS n_points_after,
       round(overall_completeness, 6) AS overall_completeness, quality_flag
FROM flags JOIN bounds USING (shot_id)
JOIN (SELECT shot_id, count(*) AS n_points_before FROM series GROUP BY shot_id) USING (shot_id)""",
    "ts_quality_summary": f"""WITH {USER_SERIES_SQL}, {CLEANED}, {QUALITY}
SELECT count(*) AS n_series, round(avg(overall_completeness), 6) AS mean_completeness,
       CAST(sum(o0 + o1 + o2 + o3) AS BIGINT) AS total_outliers,
       count(*) FILTER (quality_flag = 'OK') AS n_ok,
       count(*) FILTER (quality_flag = 'DEGRADED') AS n_degraded,
       count(*) FILTER (quality_flag = 'REJECTED') AS n_rejected FROM flags""",
}
