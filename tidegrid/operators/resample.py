"""Resampling of irregular series to a uniform grid, for all series at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.config import GRID_BLOCK_ROWS, SPLIT_ROWS
from tidegrid.functions.numeric import clean_doubles
from tidegrid.operators.series import ALL_ROWS, over, repartition_blocks, split_series

# Blocks that one array of block numbers may name.
BLOCK_RANGE = 1024


def grid_bounds(df: DataFrame, keys: Sequence[str], time: str, hz: float) -> DataFrame:
    """First and last time of each series and its number of grid points."""
    return (
        df.groupBy(*keys)
        .agg(F.min(time).alias("t_min"), F.max(time).alias("t_max"))
        .withColumn("n_grid", F.expr(_grid_size("t_min", "t_max", hz)))
    )


def resample_to_grid(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    hz: float,
    tie: Sequence[str] = (),
    split_rows: int = SPLIT_ROWS,
    block_rows: int = GRID_BLOCK_ROWS,
) -> DataFrame:
    """Linear interpolation of every value column on the uniform grid of its series."""
    segments = grid_segments(df, keys, time, values, hz, tie, split_rows, block_rows)
    return grid_points(segments, keys, time, values, block_rows).select(*keys, "_k", time, *values)


def grid_segments(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    hz: float,
    tie: Sequence[str] = (),
    split_rows: int = SPLIT_ROWS,
    block_rows: int = GRID_BLOCK_ROWS,
    halo: int = 0,
) -> DataFrame:
    """Each source row with the grid points it determines, hash-partitioned by grid block.

    A source row owns the grid points up to the next source row, ``_lo`` to ``_hi``, on which
    every signal is a line. Rows that own none are dropped, and a segment is cut at the edges of
    the blocks of ``block_rows`` points, so the second shuffle moves segments, not points. A
    block also receives the ``halo`` points on each side of it. Columns beside these: keys,
    ``_b`` block, ``_t0 _t1 _step _n`` the grid, per signal ``_from _base _slope`` the line and
    ``_valid`` the number of valid source points in the whole series.
    """
    order = [time, *tie]
    rows = df.select(*dict.fromkeys([*keys, *order, *values])).where(F.col(time).isNotNull())
    rows = clean_doubles(rows, [time, *values])
    rows = rows.where(F.abs(time) < float("inf"))  # neither missing nor infinite
    rows, path = split_series(rows, keys, order, split_rows)
    rows = rows.withColumn("_rank", F.lit(0))
    points = {v: _point(time, v) for v in values}
    if path:
        rows = _with_edges(rows, keys, path, order, time, values)
        points = {v: f"if(_rank = 0, {p}, `_edge_{v}`)" for v, p in points.items()}
    # The points are built behind the shuffle, so that it moves each value once.
    rows = rows.repartition(*keys, *path)
    rows = rows.selectExpr("*", *[f"{p} AS `_p_{v}`" for v, p in points.items()])

    here = over([*keys, *path], ["_rank", *order])
    whole = over([*keys, *path], ["_rank", *order], ALL_ROWS)
    t0, t1 = f"min(`{time}`) {whole}", f"max(`{time}`) {whole}"
    valid = {v: f"count(`{v}`) {whole}" for v in values}
    if path:
        t0, t1 = f"coalesce(_first, {t0})", f"coalesce(_last, {t1})"
        valid = {v: f"coalesce(max(`_all_{v}`) {whole}, {c})" for v, c in valid.items()}
    carried = [f"`_valid_{v}`" for v in values]
    rows = rows.selectExpr(
        *[f"`{c}`" for c in dict.fromkeys([*keys, *path, "_rank", *order])],
        f"{t0} AS _t0",
        f"{t1} AS _t1",
        *[f"{c} AS `_valid_{v}`" for v, c in valid.items()],
        *[f"last(`_p_{v}`, true) {here} AS `_prev_{v}`" for v in values],
        *[f"lead(`_p_{v}`, 1) IGNORE NULLS {here} AS `_next_{v}`" for v in values],
    )
    rows = rows.selectExpr("*", f"{_grid_size('_t0', '_t1', hz)} AS _n")
    rows = rows.selectExpr("*", "if(_n > 1, (_t1 - _t0) / (_n - 1), 0D) AS _step")
    rows = rows.selectExpr("*", f"CAST(ceil((`{time}` - _t0) / nullif(_step, 0D)) AS BIGINT) AS _guess")
    rows = rows.selectExpr("*", f"{_first_grid_index(time)} AS _k0")
    rows = rows.selectExpr("*", f"coalesce(lead(_k0) {here} - 1, _n - 1) AS _k1")

    segments = rows.where("_rank = 0 AND _k0 <= _k1").selectExpr(
        *[f"`{k}`" for k in keys],
        "_t0",
        "_t1",
        "_step",
        "_n",
        "_k0",
        "_k1",
        *carried,
        *[line for v in values for line in _line(v)],
        f"greatest((_k0 - {halo}) div {block_rows}, 0L) AS _b0",
        f"least((_k1 + {halo}) div {block_rows}, (_n - 1) div {block_rows}) AS _b1",
    )
    # A very long hole spans very many blocks: first ranges of blocks, then the blocks of a range.
    segments = segments.selectExpr("*", f"explode(sequence(_b0 div {BLOCK_RANGE}, _b1 div {BLOCK_RANGE})) AS _range")
    segments = segments.selectExpr(
        "*",
        f"explode(sequence(greatest(_b0, _range * {BLOCK_RANGE}), least(_b1, (_range + 1) * {BLOCK_RANGE} - 1))) AS _b",
    ).drop("_b0", "_b1", "_range")
    segments = segments.selectExpr(
        "*",
        f"greatest(_k0, _b * {block_rows} - {halo}) AS _lo",
        f"least(_k1, (_b + 1) * {block_rows} - 1 + {halo}) AS _hi",
    )
    segments = segments.where("_lo <= _hi").drop("_k0", "_k1")
    return repartition_blocks(segments, keys)


def grid_points(
    segments: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    block_rows: int = GRID_BLOCK_ROWS,
) -> DataFrame:
    """The grid points of segments, one row each, in the partitioning of the segments.

    Adds ``_k`` grid index, time, values and ``_core``, which is false for the halo points copied
    from neighbouring blocks.
    """
    points = segments.selectExpr("*", "explode(sequence(_lo, _hi)) AS _k")
    points = points.selectExpr("*", f"{_grid_time('_k')} AS _x")
    return points.selectExpr(
        *[f"`{k}`" for k in keys],
        "_b",
        f"_k div {block_rows} = _b AS _core",
        "_k",
        f"_x AS `{time}`",
        *[f"{_on_line(v)} AS `{v}`" for v in values],
        "_n",
        *[f"`_valid_{v}`" for v in values],
    )


def _grid_size(t0: str, t1: str, hz: float) -> str:
    return f"CAST(rint(({t1} - {t0}) * {float(hz)!r}D) AS BIGINT) + 1"


def _grid_time(k: str) -> str:
    return f"if({k} = _n - 1 AND _n > 1, _t1, {k} * _step + _t0)"


def _first_grid_index(time: str) -> str:
    """Smallest grid index at or after the row; the quotient may be off by one through rounding."""
    return f"""CASE
        WHEN `{time}` IS NULL THEN NULL
        WHEN _guess IS NULL THEN if(`{time}` > _t0, 1L, 0L)
        WHEN {_grid_time('(_guess - 1)')} >= `{time}` THEN greatest(_guess - 1, 0L)
        WHEN {_grid_time('_guess')} >= `{time}` THEN _guess
        ELSE _guess + 1 END"""


def _point(time: str, value: str) -> str:
    return f"if(`{value}` IS NULL, NULL, named_struct('t', `{time}`, 'v', `{value}`))"


def _line(value: str) -> list[str]:
    """Start time, start value and slope of a signal on one segment.

    Before the first valid point and after the last one the line is flat. From an infinite start
    it stays there, unless it leads to the opposite infinity, which leaves it undefined.
    """
    a, b = f"`_prev_{value}`", f"`_next_{value}`"
    return [
        f"coalesce({a}.t, {b}.t) AS `_from_{value}`",
        f"if(`_valid_{value}` < 2, NULL, coalesce({a}.v, {b}.v)) AS `_base_{value}`",
        f"""CASE
        WHEN {a} IS NULL OR {b} IS NULL THEN 0D
        WHEN abs({a}.v) = double('Infinity') THEN if({b}.v = -{a}.v, double('NaN'), 0D)
        ELSE ({b}.v - {a}.v) / ({b}.t - {a}.t) END AS `_slope_{value}`""",
    ]


def _on_line(value: str) -> str:
    start, base = f"`_from_{value}`", f"`_base_{value}`"
    return f"if(_x = {start}, {base}, nanvl(`_slope_{value}` * (_x - {start}) + {base}, NULL))"


def _with_edges(
    rows: DataFrame,
    keys: Sequence[str],
    path: Sequence[str],
    order: Sequence[str],
    time: str,
    values: Sequence[str],
) -> DataFrame:
    """Add to each block of a long series what lies beyond its edges.

    A row of rank -1 carries the last valid points before the block, one of rank 1 the next time
    and the next valid points after it. Both come from one summary row per block.
    """
    order_key = ", ".join(f"`{c}`" for c in order)
    at = {v: f"{_point(time, v)}, if(`{v}` IS NULL, NULL, struct({order_key}))" for v in values}
    summary = (
        rows.where(f"{path[0]} IS NOT NULL")
        .groupBy(*keys, *path)
        .agg(
            F.min(time).alias("_start"),
            F.first("_first").alias("_first"),
            F.first("_last").alias("_last"),
            *[F.count(v).alias(f"_cnt_{v}") for v in values],
            *[F.expr(f"min_by({at[v]}) AS `_lo_{v}`") for v in values],
            *[F.expr(f"max_by({at[v]}) AS `_hi_{v}`") for v in values],
        )
    )
    series, along = over(keys), over(keys, path)
    shared = [*[f"`{c}`" for c in [*keys, *path]], "_first", "_last"]
    summary = summary.selectExpr(
        *shared,
        f"lead(_start) {along} AS _after",
        *[f"sum(`_cnt_{v}`) {series} AS `_all_{v}`" for v in values],
        *[f"lag(`_hi_{v}`, 1) IGNORE NULLS {along} AS `_left_{v}`" for v in values],
        *[f"lead(`_lo_{v}`, 1) IGNORE NULLS {along} AS `_right_{v}`" for v in values],
    )
    shared += [f"`_all_{v}`" for v in values]
    before = summary.selectExpr(
        *shared, "-1 AS _rank", *[f"`_left_{v}` AS `_edge_{v}`" for v in values]
    )
    after = summary.selectExpr(
        *shared,
        "1 AS _rank",
        f"_after AS `{time}`",
        *[f"`_right_{v}` AS `_edge_{v}`" for v in values],
    )
    return rows.unionByName(before, allowMissingColumns=True).unionByName(
        after, allowMissingColumns=True
    )
