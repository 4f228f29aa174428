"""Compiled work on sorted blocks: rolling medians and gap filling, many series per batch.

Spark partitions the blocks, sorts them and hands over Arrow batches; the functions here only do
array arithmetic on one batch at a time. A block that a batch boundary cuts is held back until
its rest arrives, so at most one block beyond the batch is in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


# Work on one call is cut at block edges once it exceeds this many rows.
ROWS_PER_CALL = 500_000


def map_blocks(
    blocks: DataFrame,
    order: Sequence[str],
    schema: T.StructType,
    work: Callable,
    size: str | None = None,
) -> DataFrame:
    """Apply ``work`` to runs of whole blocks.

    ``order`` sorts the rows inside a partition, block by block, and ``_start`` marks the first
    row of every block. ``work(column, starts)`` receives a function that returns a column as an
    array and the positions of the block starts. It returns the source row of each output row and
    the arrays of the columns it computed; other columns are copied. ``size`` names the column
    that tells how many rows ``work`` will make of a row.
    """
    limit = ROWS_PER_CALL

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def finish(table):
            starts = np.flatnonzero(table["_start"].to_numpy())
            rows = table[size].to_numpy() if size else np.ones(len(table), dtype="int64")
            before = np.cumsum(rows) - rows
            call = before[starts] // limit
            cuts = starts[np.flatnonzero(np.diff(call, prepend=-1))]
            for lo, hi in zip(cuts, np.append(cuts[1:], len(table))):
                part = table.slice(lo, hi - lo).combine_chunks()
                inside = starts[(starts >= lo) & (starts < hi)] - lo
                source, made = work(lambda name: part[name].to_numpy(), inside)  # noqa: B023
                out = []
                for f in schema.fields:
                    if f.name in made:
                        # A float NaN is a missing value.
                        out.append(pa.array(made[f.name], from_pandas=made[f.name].dtype.kind == "f"))
                    else:
                        out.append(part[f.name].take(source).combine_chunks())
                yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            cut = int(np.flatnonzero(table["_start"].to_numpy())[-1])
            if cut:
                yield from finish(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and len(held):
            yield from finish(held)

    return blocks.sortWithinPartitions(*order).mapInArrow(run, schema)


def expander(block_rows: int) -> Callable:
    """Grid points of segments: source segment, grid index, time and whether it is a core point."""

    def expand(column):
        import numpy as np

        lo, block = column("_lo"), column("_b")
        length = column("_hi") - lo + 1
        first = np.cumsum(length) - length
        row = np.repeat(np.arange(len(lo)), length)
        k = lo[row] + np.arange(len(row)) - first[row]
        n = column("_n")[row]
        t = np.where(
            (k == n - 1) & (n > 1), column("_t1")[row], k * column("_step")[row] + column("_t0")[row]
        )
        return first, row, k, t, k // block_rows == block[row]

    return expand


def line_values() -> Callable:
    """Values at times ``t`` of lines given by start time, start value and slope."""

    def on_line(start, base, slope, t):
        import numpy as np

        with np.errstate(invalid="ignore"):
            return np.where(t == start, base, slope * (t - start) + base)

    return on_line


def padded_median(window: int) -> Callable:
    """A centered rolling median that does not look across block starts.

    Blocks are laid out with enough missing rows between them that no frame reaches a neighbour.
    """

    def median(values, starts):
        import numpy as np
        import pandas as pd

        lengths = np.diff(np.append(starts, len(values)))
        place = np.arange(len(values)) + np.repeat(np.arange(len(starts)) * (window // 2), lengths)
        spread = np.full(int(place[-1]) + 1, np.nan)
        spread[place] = values
        rolled = pd.Series(spread).rolling(window, center=True, min_periods=1).median()
        return rolled.to_numpy()[place]

    return median


def gap_filler(max_gap: int) -> Callable:
    """Linear filling by position of gaps of at most ``max_gap`` rows within each block."""

    def fill(values, starts):
        import numpy as np

        missing = np.isnan(values)
        if not missing.any():
            return values
        n = len(values)
        lengths = np.diff(np.append(starts, n))
        first = np.repeat(starts, lengths)
        end = np.repeat(starts + lengths, lengths)
        at = np.arange(n)
        before = np.maximum.accumulate(np.where(missing, -1, at))
        after = np.minimum.accumulate(np.where(missing, n, at)[::-1])[::-1]
        holes = np.flatnonzero(missing)
        i, lo, hi = holes, before[holes], after[holes]
        no_left, no_right = lo < first[holes], hi >= end[holes]
        gap = np.where(no_right, end[holes], hi) - np.where(no_left, first[holes] - 1, lo) - 1
        left = values[np.where(no_left, i, lo)]
        right = values[np.where(no_right, i, hi)]
        line = (right - left) / np.maximum(hi - lo, 1) * (i - lo) + left
        filled = np.where(no_left, right, np.where(no_right, left, line))
        out = values.copy()
        out[holes] = np.where(gap <= max_gap, filled, np.nan)
        return out

    return fill
