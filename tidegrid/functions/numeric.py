"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_if_nan(c: Column) -> Column:
    """NaN means missing in sensor files; inside the engine missing is always NULL."""
    return F.when(~F.isnan(c), c)


def clean_doubles(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: null_if_nan(F.col(c).cast("double")) for c in cols})


def round_exactly(x: str, digits: int) -> str:
    """SQL for ``x`` rounded half to even on its exact binary value.

    The built-in rounding works on the shortest decimal text of a double, which turns values such
    as 0.98125 into ties that the stored number is not. Splitting ``x`` into two halves of at most
    27 bits makes the products below exact, so the sign of the remainder decides correctly.
    ``digits`` is at most 4.
    """
    scale = 10**digits
    base = f"floor(({x}) * {scale}D)"
    high = f"(134217729D * ({x}) - (134217729D * ({x}) - ({x})))"
    twice = f"{2 * scale}D"
    rest = f"(({high} * {twice} - (2 * {base} + 1)) + (({x}) - {high}) * {twice})"
    whole = f"if({rest} > 0 OR ({rest} = 0 AND {base} % 2 <> 0), {base} + 1, {base})"
    return f"if(isnan({x}) OR abs({x}) > 4e11D, {x}, {whole} / {scale}D)"
