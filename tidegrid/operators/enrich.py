"""The dimension table: one row per recording with context, quality, features and lineage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import PIPELINE_VERSION, SIGNAL_COLUMNS
from tidegrid.functions.numeric import round_exactly

# Source names of the descriptive columns, their names in the dimension table
# and their types; the column order is part of the contract.
CONTEXT = (
    ("operator", "operator", "string"),
    ("machine_config", "machine_config", "string"),
    ("file_format", "source_format", "string"),
    ("current_unit", "source_current_unit", "string"),
    ("column_naming_scheme", "source_column_naming", "string"),
    ("sampling_hz", "source_sampling_hz", "int"),
    ("disruption", "declared_disruption", "boolean"),
    ("disruption_time_s", "declared_disruption_time_s", "double"),
    ("duration_s", "declared_duration_s", "double"),
)
SENSORS = tuple(zip(("plasma_current", "density", "temperature", "vloop"), SIGNAL_COLUMNS))
FEATURES = (
    "duration_effective_s",
    "n_samples_after_cleaning",
    "plasma_current_max_MA",
    "plasma_current_mean_MA",
    "electron_density_mean",
    "electron_temperature_mean",
    "disruption_detected",
    "disruption_time_detected_s",
)
PREVIEW = (
    "shot_id",
    "machine_config",
    "quality_flag",
    "overall_completeness",
    "declared_disruption",
    "disruption_detected",
    "plasma_current_max_MA",
)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def enrich(
    metadata: DataFrame,
    quality: DataFrame,
    features: DataFrame,
    processed_at: str | None = None,
) -> DataFrame:
    """Merge the three inputs on ``shot_id`` into the 31-column table.

    Recordings without a quality report or features keep their row; absent completeness counts
    as 0 and absent outliers as 0.
    """
    joined = metadata.join(quality, "shot_id", "left").join(features, "shot_id", "left")
    context = [_optional(metadata, c, kind).alias(name) for c, name, kind in CONTEXT]
    outliers = F.col("outliers_per_signal")
    return joined.select(
        F.col("shot_id").cast("long").alias("shot_id"),
        *context,
        F.coalesce("quality_flag", F.lit("REJECTED")).alias("quality_flag"),
        _rounded("coalesce(overall_completeness, 0D)").alias("overall_completeness"),
        *[
            _rounded(f"coalesce(completeness_per_signal['{s}'], 0D)").alias(f"completeness_{short}")
            for short, s in SENSORS
        ],
        *[
            F.coalesce(outliers[s], F.lit(0)).cast("long").alias(f"outliers_{short}")
            for short, s in SENSORS
        ],
        *[_feature(c).alias(c) for c in FEATURES],
        _optional(metadata, "schema_applied", "string").alias("schema_applied"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        F.lit(processed_at or utc_now()).alias("processed_at_utc"),
    )


def sort_metadata(table: DataFrame) -> DataFrame:
    return table.orderBy("shot_id")


def agreement(table: DataFrame) -> DataFrame:
    """How often the declared and the detected event agree, with totals."""
    declared, detected = F.col("declared_disruption"), F.col("disruption_detected")
    return table.agg(
        F.count(F.lit(1)).alias("n_shots"),
        F.count_if(declared).alias("n_declared"),
        F.count_if(detected).alias("n_detected"),
        F.count_if(declared == detected).alias("n_agree"),
        F.avg("overall_completeness").alias("mean_completeness"),
    )


def confusion(table: DataFrame) -> DataFrame:
    return table.groupBy("declared_disruption", "disruption_detected").agg(
        F.count(F.lit(1)).alias("n_shots")
    )


def preview(table: DataFrame, rows: int | None = 3) -> DataFrame:
    """The first ``rows`` recordings in the preview columns, or all of them; the latter stay in many tasks."""
    ordered = table.select(*PREVIEW).orderBy("shot_id")
    return ordered if rows is None else ordered.limit(rows)


def _rounded(expr: str) -> Column:
    return F.expr(round_exactly(expr, 4))


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def _feature(name: str) -> Column:
    """A feature; a recording without a single row has neutral values instead."""
    neutral = {"disruption_detected": F.lit(False), "n_samples_after_cleaning": F.lit(0).cast("long")}
    if name in ("plasma_current_max_MA", "disruption_time_detected_s"):
        return F.col(name)
    absent = F.col("n_samples_after_cleaning").isNull()
    return F.when(absent, neutral.get(name, F.lit(0.0))).otherwise(F.col(name))
