"""Ordered work on series of any length.

A window over a whole series would put one hot series into one task. Here long series are cut
into order-preserving blocks first; what must cross a block edge (row numbers, neighbours)
travels in a small per-block summary or in copies of the rows near the edge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import BROADCAST_ROWS, SPLIT_ROWS
from tidegrid.session import broadcast_if_small, materialize

# The bits of ``monotonically_increasing_id`` that number the rows of a task; those above number the tasks.
TASK_MASK = (1 << 33) - 1


def split_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split_rows: int = SPLIT_ROWS,
    max_listed: int = BROADCAST_ROWS,
) -> tuple[DataFrame, list[str]]:
    """Cut series of more than ``4 * split_rows`` rows into blocks ordered like ``order``.

    Returns the frame and the block column it gained: none when every series is short, otherwise
    ``_blk0`` (NULL for short series) plus ``_first`` and ``_last``, the range of ``order[0]`` in each
    long series. The rows of long series are dealt by ranges of keys and order, so that a block has
    about ``split_rows`` rows whatever the values are: missing and infinite ones, texts and ties
    included. Small blocks share a task, which cuts its sorted rows into them, so that the number of tasks
    follows the rows and not the blocks. Only these rows are moved, and written once, as a range is not the same twice.
    Long series are listed if they are few: there is at most one per ``4 * split_rows`` input rows.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    if counts.where(F.col("_rows") > 4 * split_rows).isEmpty():  # needs the keys only, whatever the order costs
        return df, []
    long = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(order[0]).alias("_first"), F.max(order[0]).alias("_last")
    )
    long, listed = broadcast_if_small(long.where(F.col("_rows") > 4 * split_rows), max_listed)
    total = long.agg(F.sum("_rows")).first()[0] if listed != 0 else None
    if not total:
        return df, []
    rows = join_null_safe(df, long, keys)
    is_long = F.col("_rows").isNotNull()
    blocks = -(-total // split_rows)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // SPLIT_ROWS))
    path = [*keys, *order, "_tie"]
    ranged = rows.where(is_long).withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(min(blocks, tasks), *path)
    block = F.spark_partition_id().cast("long")
    if blocks > tasks:
        ranged = ranged.sortWithinPartitions(*path).withColumn("_at", F.monotonically_increasing_id())
        block = F.expr(f"(_at & ~{TASK_MASK}L) + (_at & {TASK_MASK}L) div {split_rows}")
    ranged = ranged.withColumn("_blk0", block).drop("_tie", "_rows", "_at")
    short = rows.where(~is_long).drop("_rows").withColumn("_blk0", F.lit(None).cast("long"))
    return materialize(ranged, "blocks").unionByName(short), ["_blk0"]


def join_null_safe(df: DataFrame, other: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join on ``names``, where missing keys are equal to each other."""
    other = other.withColumnsRenamed({c: f"_key_{i}" for i, c in enumerate(names)})
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(other[f"_key_{i}"]) for i, c in enumerate(names)])
    return df.join(other, same, "left").drop(*[f"_key_{i}" for i in range(len(names))])


def with_row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    index: str = "_i",
    count_valid: Sequence[str] = (),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Add the 0-based row number of each row in its series.

    For each column in ``count_valid`` also add ``_valid_<column>``, its non-null count in the
    whole series.
    """
    inner = [c for c in df.columns]
    df, path = split_series(df, keys, order, split_rows)
    here = Window.partitionBy(*keys, *path).orderBy(*order)
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    valid = {f"_valid_{c}": c for c in count_valid}
    out = df.withColumns(
        {
            index: F.row_number().over(here).cast("long") - 1,
            **{name: F.count(c).over(whole) for name, c in valid.items()},
        }
    )
    if path:
        earlier = Window.partitionBy(*keys).orderBy(*path).rowsBetween(Window.unboundedPreceding, -1)
        series = Window.partitionBy(*keys)
        offsets = (
            df.where(F.col(path[0]).isNotNull())
            .groupBy(*keys, *path)
            .agg(
                F.count(F.lit(1)).alias("_size"),
                *[F.count(c).alias(f"{name}_b") for name, c in valid.items()],
            )
            .select(
                *keys,
                *path,
                F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
                *[F.sum(f"{name}_b").over(series).alias(f"{name}_s") for name in valid],
            )
        )
        offsets, _ = broadcast_if_small(offsets)
        out = join_null_safe(out, offsets, [*keys, *path]).withColumns(
            {
                index: F.col(index) + F.coalesce("_offset", F.lit(0)),
                **{name: F.coalesce(f"{name}_s", name) for name in valid},
            }
        )
    return out.select(*inner, index, *valid)


def with_halo(
    df: DataFrame,
    index: str,
    block_rows: int,
    before: int,
    after: int,
) -> DataFrame:
    """Copy each indexed row to every block that needs it.

    ``_b`` is the block that receives the copy and ``_core`` tells whether the row belongs to it.
    A block sees ``before`` rows ahead of its first row and ``after`` rows past its last one.
    """
    first = f"greatest(({index} - {after}) div {block_rows}, 0L)"
    last = f"({index} + {before}) div {block_rows}"
    copies = df.selectExpr("*", f"explode(sequence({first}, {last})) AS _b")
    return copies.selectExpr("*", f"_b = {index} div {block_rows} AS _core")


def repartition_blocks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash-partition by series and block, into exactly ``spark.sql.shuffle.partitions`` parts.

    The rows are about to be expanded or run through heavy window functions, so their size in
    bytes is no measure of the work, and adaptive merging of small partitions would mislead.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys, "_b")


ALL_ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
ROWS_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def over(partition: Sequence[str], order: Sequence[str] = (), frame: str = "") -> str:
    """An OVER clause. Window expressions are stated in SQL, which also has IGNORE NULLS."""
    names = lambda cols: ", ".join(f"`{c}`" for c in cols)
    ordering = f" ORDER BY {names(order)}" if order else ""
    return f"OVER (PARTITION BY {names(partition)}{ordering} {frame})"
