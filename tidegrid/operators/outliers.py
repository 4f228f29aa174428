"""Rolling median, rolling MAD and the outlier test built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.config import GRID_BLOCK_ROWS, MAD_EPSILON, MAD_SCALE, SPLIT_ROWS
from tidegrid.functions.numeric import clean_doubles
from tidegrid.operators.blocks import map_blocks, padded_median
from tidegrid.operators.series import over, repartition_blocks, with_halo, with_row_index


def rolling_mad(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    window: int = 101,
    engine: str = "arrow",
    split_rows: int = SPLIT_ROWS,
    block_rows: int = GRID_BLOCK_ROWS,
) -> DataFrame:
    """Add ``local_median`` and ``local_mad`` over a centered row frame of ``window`` rows.

    Adds the row number ``_i`` and ``_valid_<value>``, the series' non-null count, as well.
    """
    df = clean_doubles(df, [value])
    indexed = with_row_index(df, keys, order, count_valid=[value], split_rows=split_rows)
    before, after = frame_reach(window)
    blocks = with_halo(indexed, "_i", block_rows, 2 * before, 2 * after)
    blocks = repartition_blocks(blocks, keys)
    if engine == "sql":
        frame = rolling_frame(keys, "_i", window)
        out = blocks.selectExpr("*", f"{median_over(f'`{value}`', frame)} AS local_median")
        deviation = f"abs(`{value}` - local_median)"
        out = out.selectExpr("*", f"{median_over(deviation, frame)} AS local_mad").where("_core")
    else:
        out = _rolling_in_arrow(blocks, keys, value, window, block_rows)
    return out.select(*indexed.columns, "local_median", "local_mad")


def detect_outliers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    threshold: float = 6.0,
    window: int = 101,
    engine: str = "arrow",
    split_rows: int = SPLIT_ROWS,
    block_rows: int = GRID_BLOCK_ROWS,
) -> DataFrame:
    """Add ``is_outlier``: a modified z-score beyond ``threshold`` inside the local frame.

    A series with fewer than ``window`` valid rows has no outliers.
    """
    out = rolling_mad(df, keys, order, value, window, engine, split_rows, block_rows)
    test = exceeds(modified_z(f"`{value}`", "local_median", "local_mad"), threshold)
    flag = f"`_valid_{value}` >= {window} AND {test} AS is_outlier"
    return out.selectExpr("*", flag).drop(f"_valid_{value}")


def nullify_outliers(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn(value, F.when(~F.col("is_outlier"), F.col(value)))


def frame_reach(window: int) -> tuple[int, int]:
    """Rows before and after the current one in a centered frame of ``window`` rows."""
    return window // 2, (window - 1) // 2


def rolling_frame(keys: Sequence[str], index: str, window: int) -> str:
    before, after = frame_reach(window)
    return over([*keys, "_b"], [index], f"ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING")


def median_over(expr: str, frame: str) -> str:
    """Infinite values count as missing here, as they do in a rolling median of sensor data."""
    return f"percentile(if(abs({expr}) = double('Infinity'), NULL, {expr}), 0.5) {frame}"


def modified_z(value: str, median: str, mad: str) -> str:
    return f"{MAD_SCALE}D * ({value} - {median}) / ({mad} + {MAD_EPSILON}D)"


def exceeds(z: str, threshold: float) -> str:
    return f"coalesce(NOT isnan({z}) AND abs({z}) > {float(threshold)!r}D, false)"


def _rolling_in_arrow(
    blocks: DataFrame, keys: Sequence[str], value: str, window: int, block_rows: int
) -> DataFrame:
    reach = 2 * frame_reach(window)[0]
    kept = [f for f in blocks.schema.fields if f.name not in ("_b", "_core")]
    added = [T.StructField(c, T.DoubleType()) for c in ("local_median", "local_mad")]
    blocks = blocks.selectExpr("*", f"_i = greatest(_b * {block_rows} - {reach}, 0L) AS _start")
    median = padded_median(window)

    def roll(column, starts):
        import numpy as np

        v = column(value).astype(float)
        local = median(v, starts)
        with np.errstate(invalid="ignore"):
            mad = median(np.abs(v - local), starts)
        core = np.flatnonzero(column("_core"))
        return core, {"local_median": local[core], "local_mad": mad[core]}

    return map_blocks(blocks, [*keys, "_b", "_i"], T.StructType([*kept, *added]), roll)
