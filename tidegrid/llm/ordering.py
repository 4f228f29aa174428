"""Rows in one global order, numbered or summed up without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import materialize

ROW_BITS = 33


def wrapped(df: DataFrame, name: str = "_doc") -> Column:
    """All columns of ``df`` as one, so that no name of theirs meets one of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def in_order(df: DataFrame, order: list[Column], at: str) -> DataFrame:
    """A written table of ``df`` in the given order; column ``at`` numbers the rows with gaps.

    Rows are dealt by ranges of the whole order, so that equal keys may span many tasks. The
    numbers rise with the order; rows equal in it are numbered in any way. The upper bits of a
    number name the range, the lower ``ROW_BITS`` the place within it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("_tie")]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    numbered = dealt.sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id())
    return materialize(numbered.drop("_tie"), "order")


def range_of(at: str) -> Column:
    return F.shiftright(F.col(at), ROW_BITS)


def row_numbers(ordered: DataFrame, at: str, name: str) -> tuple[DataFrame, int]:
    """``ordered`` (made by :func:`in_order`) with gapless numbers from 0, and the row count.

    One row per range is summed up on the way, so that table is as small as the list of tasks.
    """
    counts = ordered.groupBy(range_of(at).alias("_range")).agg(F.count("*").alias("_rows")).collect()
    before, total = [], 0
    for r in sorted(counts, key=lambda r: r["_range"]):
        before.append((r["_range"], total))
        total += r["_rows"]
    offsets = ordered.sparkSession.createDataFrame(before, "_range long, _before long")
    place = F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("long"))
    joined = ordered.join(F.broadcast(offsets), range_of(at) == F.col("_range"))
    return joined.withColumn(name, F.col("_before") + place).drop("_range", "_before"), total


def sum_before(df: DataFrame, at: str, group: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over earlier rows (by ``at``) of the same ``group``."""
    ranged = df.withColumn("_range", range_of(at))
    totals = ranged.groupBy(group, "_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy("_range", group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = (F.col("_range") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group"))
    joined = inside.join(offsets, same).withColumn(name, F.col("_before") + F.col("_inside"))
    return joined.drop("_range", "_inside", "_group", "_of", "_before")
