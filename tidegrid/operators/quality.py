"""Quality of each cleaned series and of the whole data set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import QUALITY_FLAGS, CleaningConfig
from tidegrid.functions.numeric import round_exactly
from tidegrid.operators.clean import MASK


def quality_flag(
    completeness: Column, config: CleaningConfig = CleaningConfig()
) -> Column:
    ok, degraded, rejected = QUALITY_FLAGS
    return (
        F.when(completeness >= config.ok_completeness, ok)
        .when(completeness >= config.degraded_completeness, degraded)
        .otherwise(rejected)
    )


def signal_counts(cleaned: DataFrame, keys: Sequence[str], signals: Sequence[str]) -> DataFrame:
    """Per series: grid points, remaining nulls and outliers of each signal, in one pass."""
    return cleaned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points_after"),
        *[F.count_if(F.col(s).isNull()).alias(f"_null_{s}") for s in signals],
        *[
            F.count_if(F.col(MASK).bitwiseAND(F.lit(1 << j)) != 0).alias(f"_out_{s}")
            for j, s in enumerate(signals)
        ],
    )


def signal_quality(cleaned: DataFrame, keys: Sequence[str], signals: Sequence[str]) -> DataFrame:
    """Long form: ``(keys, signal, completeness, n_outliers)``."""
    counts = signal_counts(cleaned, keys, signals)
    per_signal = F.array(
        *[
            F.struct(
                F.lit(s).alias("signal"),
                _completeness(s).alias("completeness"),
                F.col(f"_out_{s}").alias("n_outliers"),
            )
            for s in signals
        ]
    )
    return counts.select(*keys, F.inline(per_signal))


def quality_report(
    raw: DataFrame,
    cleaned: DataFrame,
    keys: Sequence[str],
    config: CleaningConfig = CleaningConfig(),
    rounded: bool = False,
) -> DataFrame:
    """One row per series: points before and after, maps per signal, completeness and flag.

    ``rounded`` gives the exported form with completeness rounded to 4 places; the flag always
    follows the unrounded value. A series without a single grid point is REJECTED.
    """
    signals = [s for s in config.signal_columns if s in cleaned.columns]
    before = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points_before"))
    report = before.join(signal_counts(cleaned, keys, signals), list(keys), "left")
    report = report.withColumns(
        {
            "n_points_after": F.coalesce("n_points_after", F.lit(0)),
            "completeness_per_signal": _map(signals, _completeness, "double"),
            "outliers_per_signal": _map(
                signals, lambda s: F.coalesce(F.col(f"_out_{s}"), F.lit(0)), "bigint"
            ),
            "overall_completeness": (
                sum((_completeness(s) for s in signals), F.lit(0.0)) / len(signals)
                if signals
                else F.lit(0.0)
            ),
        }
    )
    report = report.withColumn("quality_flag", quality_flag(F.col("overall_completeness"), config))
    if rounded:
        report = report.withColumns(
            {
                "overall_completeness": F.expr(round_exactly("overall_completeness", 4)),
                "completeness_per_signal": F.expr(
                    f"transform_values(completeness_per_signal, (k, c) -> {round_exactly('c', 4)})"
                ),
            }
        )
    return report.select(
        *keys,
        "n_points_before",
        "n_points_after",
        "completeness_per_signal",
        "outliers_per_signal",
        "overall_completeness",
        "quality_flag",
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """One row: series, mean completeness, total outliers and a count for every flag."""
    outliers = F.aggregate(
        F.map_values("outliers_per_signal"), F.lit(0).cast("long"), lambda a, b: a + b
    )
    return report.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.avg("overall_completeness").alias("mean_completeness"),
        F.coalesce(F.sum(outliers), F.lit(0)).alias("total_outliers"),
        *[
            F.count_if(F.col("quality_flag") == flag).alias(f"n_{flag.lower()}")
            for flag in QUALITY_FLAGS
        ],
    )


def _completeness(signal: str) -> Column:
    n = F.col("n_points_after")
    return F.when(n > 0, F.lit(1.0) - F.col(f"_null_{signal}") / n).otherwise(0.0)


def _map(signals, value, kind) -> Column:
    pairs = [x for s in signals for x in (F.lit(s), value(s))]
    return F.create_map(*pairs).cast(f"map<string,{kind}>") if pairs else F.lit(None).cast(
        f"map<string,{kind}>"
    )
