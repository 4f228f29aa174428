"""Resample, remove outliers and fill short gaps, for all series in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.config import MAD_EPSILON, MAD_SCALE, CleaningConfig
from tidegrid.operators.blocks import (
    expander,
    gap_filler,
    line_values,
    map_blocks,
    padded_median,
)
from tidegrid.operators.impute import fill_in_blocks
from tidegrid.operators.outliers import exceeds, median_over, modified_z, rolling_frame
from tidegrid.operators.resample import grid_points, grid_segments

MASK = "outlier_mask"


def clean_series(
    df: DataFrame,
    keys: Sequence[str],
    config: CleaningConfig = CleaningConfig(),
    tie: Sequence[str] = (),
    keep_extra: bool = False,
) -> DataFrame:
    """Clean every series of ``df``.

    Returns keys, ``_k`` grid index, time, the signals present and ``outlier_mask``, an integer
    with bit ``j`` set where signal ``j`` was an outlier. Other numeric columns are dropped, or
    resampled but not cleaned with ``keep_extra``.
    """
    signals = [c for c in config.signal_columns if c in df.columns]
    extra = []
    if keep_extra:
        fixed = {*keys, *tie, config.time_column, *signals}
        extra = [
            f.name
            for f in df.schema.fields
            if f.name not in fixed and isinstance(f.dataType, T.NumericType)
        ]
    values = [*signals, *extra]
    segments = grid_segments(
        df,
        keys,
        config.time_column,
        values,
        config.target_sampling_hz,
        tie,
        config.split_rows,
        config.block_rows,
        halo=config.halo_rows,
    )
    if config.engine == "arrow":
        return _clean_in_arrow(segments, keys, signals, extra, config)
    points = grid_points(segments, keys, config.time_column, values, config.block_rows)
    columns = [*keys, "_b", "_k", config.time_column, *values, MASK]
    if not signals:
        return points.where("_core").withColumn(MASK, F.lit(0)).select(*columns)
    return _clean_in_sql(points, keys, signals, config).select(*columns)


def _enough_points(signal: str, config: CleaningConfig) -> str:
    """A resampled signal is valid at every grid point or at none."""
    return f"(`_valid_{signal}` >= 2 AND _n >= {config.mad_window})"


def _clean_in_sql(blocks, keys, signals, config) -> DataFrame:
    frame = rolling_frame(keys, "_k", config.mad_window)
    blocks = blocks.selectExpr("*", *[f"{median_over(f'`{s}`', frame)} AS `_med_{s}`" for s in signals])
    blocks = blocks.selectExpr(
        "*", *[f"{median_over(f'abs(`{s}` - `_med_{s}`)', frame)} AS `_mad_{s}`" for s in signals]
    )
    tests = {
        s: exceeds(modified_z(f"`{s}`", f"`_med_{s}`", f"`_mad_{s}`"), config.outlier_mad_threshold)
        for s in signals
    }
    blocks = blocks.selectExpr(
        "*", *[f"{_enough_points(s, config)} AND {t} AS `_out_{s}`" for s, t in tests.items()]
    )
    mask = " + ".join(f"if(`_out_{s}`, {1 << j}, 0)" for j, s in enumerate(signals))
    blocks = blocks.withColumns(
        {MASK: F.expr(mask), **{s: F.expr(f"if(`_out_{s}`, NULL, `{s}`)") for s in signals}}
    )
    return fill_in_blocks(blocks, keys, "_k", signals, config.max_gap_to_impute).where("_core")


def _clean_in_arrow(segments, keys, signals, extra, config) -> DataFrame:
    """The same steps on arrays. Segments are expanded there, so fewer rows cross to Python."""
    time, values = config.time_column, [*signals, *extra]
    rows, halo = config.block_rows, config.halo_rows
    segments = segments.selectExpr(
        "*",
        f"_lo = greatest(_b * {rows} - {halo}, 0L) AS _start",
        "_hi - _lo + 1 AS _size",
        *[f"{_enough_points(s, config)} AS `_test_{s}`" for s in signals],
    )
    made = [T.StructField("_k", T.LongType())]
    made += [T.StructField(c, T.DoubleType()) for c in (time, *values)]
    schema = T.StructType(
        [segments.schema[c] for c in (*keys, "_b")] + made + [T.StructField(MASK, T.IntegerType())]
    )
    expand, median = expander(rows), padded_median(config.mad_window)
    fill, line = gap_filler(config.max_gap_to_impute), line_values()
    threshold, scale, epsilon = config.outlier_mad_threshold, MAD_SCALE, MAD_EPSILON

    def clean(column, starts):
        import numpy as np

        first, row, k, t, core = expand(column)
        starts = first[starts]
        mask = np.zeros(len(k), dtype="int32")
        out = {"_k": k[core], time: t[core]}
        for j, s in enumerate(values):
            parts = [column(f"_{part}_{s}").astype(float)[row] for part in ("from", "base", "slope")]
            v = line(*parts, t)
            if s in signals:
                with np.errstate(invalid="ignore", over="ignore"):
                    off = v - median(v, starts)
                    z = scale * off / (median(np.abs(off), starts) + epsilon)
                    bad = (np.abs(z) > threshold) & column(f"_test_{s}")[row]
                mask |= bad.astype("int32") << j
                v = fill(np.where(bad, np.nan, v), starts)
            out[s] = v[core]
        out[MASK] = mask[core]
        return row[core], out

    return map_blocks(segments, [*keys, "_b", "_lo"], schema, clean, size="_size")
