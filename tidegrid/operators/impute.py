"""Gaps in indexed series: labelling them and filling the short ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import GRID_BLOCK_ROWS, SPLIT_ROWS
from tidegrid.functions.numeric import clean_doubles
from tidegrid.operators.series import (
    ALL_ROWS,
    ROWS_SO_FAR,
    over,
    repartition_blocks,
    with_halo,
    with_row_index,
)

# Blocks whose edges are looked at together.
MERGED = 4096


def gap_islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    max_gap: int = 100,
    split_rows: int = SPLIT_ROWS,
    block_rows: int = GRID_BLOCK_ROWS,
) -> DataFrame:
    """One row per run of missing values: ``gap_start``, ``gap_end``, ``gap_rows``, ``is_short``.

    Runs are found inside blocks of row numbers. Those that touch the edge of a block are then put together in
    ever larger blocks, each of ``MERGED`` of the ones before, so that no task sees more of a
    series than that many edges, however long the series or a run in it is.
    """
    indexed = with_row_index(clean_doubles(df, [value]), keys, order, split_rows=split_rows)
    missing = indexed.where(F.col(value).isNull()).withColumn("_b", F.floor(F.col("_i") / block_rows))
    run = F.expr(f"_i - row_number() {over([*keys, '_b'], ['_i'])}")
    runs = (
        missing.select(*keys, "_b", "_i", run.alias("_run"))
        .groupBy(*keys, "_b", "_run")
        .agg(F.min("_i").alias("gap_start"), F.max("_i").alias("gap_end"))
    )
    whole = merge_runs(runs.select(*keys, "gap_start", "gap_end"), keys, block_rows)
    rows = F.col("gap_end") - F.col("gap_start") + 1
    return whole.withColumn("gap_rows", rows).withColumn("is_short", F.col("gap_rows") <= max_gap)


def merge_runs(runs: DataFrame, keys: Sequence[str], block_rows: int, merged: int = MERGED) -> DataFrame:
    """Join runs that follow one another; none goes over the edge of a block of ``block_rows`` rows.

    A run that ends inside its block is done and stays in a partition of its own.
    """
    size = block_rows
    for larger in (size * merged, size * merged**2, None):
        open_at_edge = (F.col("gap_start") % size == 0) | ((F.col("gap_end") + 1) % size == 0)
        block = F.floor(F.col("gap_start") / larger) if larger else F.lit(0).cast("long")
        runs = runs.withColumn("_in", block).withColumn("_done", F.when(~open_at_edge, F.col("gap_start")))
        along = Window.partitionBy(*keys, "_in", "_done").orderBy("gap_start")
        touching = F.col("gap_start") == F.lag("gap_end").over(along) + 1
        numbered = runs.withColumn("_new", F.when(touching, 0).otherwise(1)).withColumn("_gap", F.sum("_new").over(along))
        runs = numbered.groupBy(*keys, "_in", "_done", "_gap").agg(
            F.min("gap_start").alias("gap_start"), F.max("gap_end").alias("gap_end")
        ).select(*keys, "gap_start", "gap_end")
        size = larger
    return runs


def impute_short_gaps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    max_gap: int = 100,
    split_rows: int = SPLIT_ROWS,
    block_rows: int = GRID_BLOCK_ROWS,
) -> DataFrame:
    """Fill gaps of at most ``max_gap`` rows linearly by row position; longer ones stay NULL."""
    df = clean_doubles(df, list(values))
    indexed = with_row_index(df, keys, order, split_rows=split_rows)
    blocks = repartition_blocks(with_halo(indexed, "_i", block_rows, max_gap, max_gap), keys)
    return fill_in_blocks(blocks, keys, "_i", values, max_gap).where("_core").select(*indexed.columns)


def fill_in_blocks(
    blocks: DataFrame, keys: Sequence[str], index: str, values: Sequence[str], max_gap: int
) -> DataFrame:
    """Imputation inside blocks whose halo is at least ``max_gap`` rows wide.

    That halo is enough: a gap that leaves it is longer than ``max_gap`` already.
    """
    here = over([*keys, "_b"], [index])
    seen = over([*keys, "_b"], [index], ROWS_SO_FAR)
    whole = over([*keys, "_b"], [index], ALL_ROWS)
    blocks = blocks.selectExpr(
        "*",
        *[f"if(`{v}` IS NULL, NULL, named_struct('i', {index}, 'v', `{v}`)) AS `_at_{v}`" for v in values],
    )
    blocks = blocks.selectExpr(
        "*",
        f"min({index}) {whole} AS _from",
        f"max({index}) {whole} AS _to",
        *[f"last(`_at_{v}`, true) {seen} AS `_prev_{v}`" for v in values],
        *[f"lead(`_at_{v}`, 1) IGNORE NULLS {here} AS `_next_{v}`" for v in values],
    )
    return blocks.withColumns({v: F.expr(_filled(index, v, max_gap)) for v in values})


def _filled(index: str, value: str, max_gap: int) -> str:
    a, b = f"`_prev_{value}`", f"`_next_{value}`"
    gap = f"coalesce({b}.i, _to + 1) - coalesce({a}.i, _from - 1) - 1"
    line = f"({b}.v - {a}.v) / ({b}.i - {a}.i) * ({index} - {a}.i) + {a}.v"
    return f"""CASE
        WHEN `{value}` IS NOT NULL THEN `{value}`
        WHEN {gap} <= {max_gap} THEN coalesce({line}, {b}.v, {a}.v) END"""
