"""Per-recording features: duration, peak, plateau means and the first abrupt drop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import SIGNAL_COLUMNS, TIME_COLUMN, FeatureConfig
from tidegrid.functions.numeric import clean_doubles, round_exactly
from tidegrid.operators.series import join_null_safe, with_row_index
from tidegrid.session import broadcast_if_small

CURRENT, DENSITY, TEMPERATURE = SIGNAL_COLUMNS[:3]


def derived_features(
    df: DataFrame,
    keys: Sequence[str],
    config: FeatureConfig = FeatureConfig(),
    tie: Sequence[str] = (),
    index: str | None = None,
    rounded: bool = True,
) -> DataFrame:
    """The eight features of every recording.

    ``index`` names a 0-based row number that is already there, such as the grid index.
    """
    rows, scale = _with_scale(df, keys, config, tie, index)
    means = [(CURRENT, "plasma_current_mean_MA"), (DENSITY, "electron_density_mean"),
             (TEMPERATURE, "electron_temperature_mean")]
    plateau = (F.col("_peak") > 0) & (F.col(CURRENT) > config.plateau_fraction * F.col("_peak"))
    out = rows.groupBy(*keys).agg(
        F.first("_duration").alias("duration_effective_s"),
        F.first("_n").alias("n_samples_after_cleaning"),
        F.first("_peak").alias("plasma_current_max_MA"),
        *[
            F.when(F.count_if(plateau) > 0, F.avg(F.when(plateau, F.col(c)))).otherwise(0.0).alias(name)
            for c, name in means
        ],
    )
    out = join_null_safe(out, _first_drops(rows, keys, config, "disruption_time_detected_s"), keys)
    out = out.withColumn("disruption_detected", F.col("disruption_time_detected_s").isNotNull())
    measures = [
        "duration_effective_s", "plasma_current_max_MA", "plasma_current_mean_MA",
        "electron_density_mean", "electron_temperature_mean", "disruption_time_detected_s",
    ]
    if rounded:
        out = out.withColumns({c: F.expr(round_exactly(c, 4)) for c in measures})
    return out.select(
        *keys, "duration_effective_s", "n_samples_after_cleaning", "plasma_current_max_MA",
        "plasma_current_mean_MA", "electron_density_mean", "electron_temperature_mean",
        "disruption_detected", "disruption_time_detected_s",
    )


def detect_disruption(
    df: DataFrame,
    keys: Sequence[str],
    config: FeatureConfig = FeatureConfig(),
    tie: Sequence[str] = (),
    index: str | None = None,
) -> DataFrame:
    """First time at which the current has lost ``drop_fraction`` of its peak within ``window_s``.

    The search starts one window in and leaves out the last ``end_margin_s``. Recordings shorter
    than the window are reported as undisrupted.
    """
    rows, scale = _with_scale(df, keys, config, tie, index)
    found = join_null_safe(scale.select(*keys), _first_drops(rows, keys, config, "disruption_time_s"), keys)
    return found.withColumn("disruption_detected", F.col("disruption_time_s").isNotNull())


def duration_and_peak(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    df = clean_doubles(df, [TIME_COLUMN, CURRENT])
    return df.groupBy(*keys).agg(
        (F.max(TIME_COLUMN) - F.min(TIME_COLUMN)).alias("duration_effective_s"),
        F.count(F.lit(1)).alias("n_samples"),
        F.max(CURRENT).alias("plasma_current_max_MA"),
    )


def _with_scale(df, keys, config, tie, index) -> tuple[DataFrame, DataFrame]:
    """Rows with their recording's size, peak, window and last searched index."""
    cols = [c for c in (CURRENT, DENSITY, TEMPERATURE) if c in df.columns]
    rows = clean_doubles(df, [TIME_COLUMN, *cols])
    if index is None:
        rows = with_row_index(rows, keys, [TIME_COLUMN, *tie], "_i", split_rows=config.split_rows)
    else:
        rows = rows.withColumn("_i", F.col(index))
    rows = rows.select(*keys, "_i", TIME_COLUMN, *cols)
    dt = F.max(F.when(F.col("_i") == 1, F.col(TIME_COLUMN))) - F.max(
        F.when(F.col("_i") == 0, F.col(TIME_COLUMN))
    )
    scale = (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            (F.max(TIME_COLUMN) - F.min(TIME_COLUMN)).alias("_duration"),
            F.max(CURRENT).alias("_peak"),
            dt.alias("_dt"),
        )
        .withColumn("_lag", _points(config.window_s))
        .withColumn(
            "_stop",
            F.greatest(F.col("_lag") + 1, F.col("_n") - _points(config.end_margin_s)),
        )
        .withColumn(
            "_searched", (F.col("_n") >= config.min_rows) & (F.col("_peak") >= config.min_peak)
        )
        .drop("_dt")
    )
    small, _ = broadcast_if_small(scale)
    return join_null_safe(rows, small, keys), scale


def _points(seconds: float) -> Column:
    """Rows in ``seconds`` at the recording's first time step, truncated, at least one."""
    ratio = F.lit(seconds) / F.when(F.col("_dt") > 0, F.col("_dt"))
    rows = F.least(ratio, F.lit(1e15)).cast("long")
    return F.greatest(F.coalesce(rows, F.lit(1)), F.lit(1))


def _first_drops(rows: DataFrame, keys: Sequence[str], config: FeatureConfig, name: str) -> DataFrame:
    """Time of the first row whose current is far below that of ``_lag`` rows before.

    The lag differs between recordings, so a window offset cannot express it. Rows are joined with
    those before by their row number. No earlier current exceeds the peak, so only rows far below
    the peak can have lost enough, and only high ones can be what they are compared with; just
    these rows, in few columns, are moved.
    """
    peak, current = F.col("_peak"), F.col(CURRENT)
    searched = rows.where("_searched")
    now = searched.where(
        (F.col("_i") >= F.col("_lag")) & (F.col("_i") < F.col("_stop")) & (peak - current > config.drop_fraction * peak)
    ).select(*keys, "_i", TIME_COLUMN, current.alias("_now"), "_peak")
    before = searched.where(current > 0.5 * peak).select(
        *[F.col(c).alias(f"_key_{c}") for c in keys], (F.col("_i") + F.col("_lag")).alias("_then"), current.alias("_earlier")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]
    pairs = now.join(before, reduce(lambda a, b: a & b, [F.col("_i") == F.col("_then"), *same]))
    dropped = pairs.where(F.col("_earlier") - F.col("_now") > config.drop_fraction * peak)
    return dropped.groupBy(*keys).agg(F.min(TIME_COLUMN).alias(name))
