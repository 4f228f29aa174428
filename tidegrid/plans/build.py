"""From raw recordings to a verified mart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import CleaningConfig, FeatureConfig, MartConfig
from tidegrid.operators.clean import clean_series
from tidegrid.operators.enrich import enrich
from tidegrid.operators.features import derived_features
from tidegrid.operators.quality import quality_report
from tidegrid.session import materialize, scratch_scope
from tidegrid.sinks.mart import write_mart
from tidegrid.sources.mart import mart_size_mb, read_errors, read_metadata, read_signals
from tidegrid.sources.recordings import SOURCE_ORDER, load_recordings
from tidegrid.sources.registry import SourceRegistry

KEYS = ["shot_id"]


@dataclass(frozen=True)
class MartBuild:
    paths: dict[str, str]
    errors: DataFrame
    verification: dict


def build_mart(
    spark: SparkSession,
    raw_dir: str,
    mart: MartConfig = MartConfig(),
    registry: SourceRegistry | None = None,
    cleaning: CleaningConfig = CleaningConfig(),
    features: FeatureConfig = FeatureConfig(),
    processed_at: str | None = None,
    extra_columns: Sequence[str] = (),
) -> MartBuild:
    """Ingest, clean, enrich, write and verify.

    The cleaned series are landed once: the quality counts, the features and the fact table all
    read them. ``extra_columns`` names raw columns that the fact table carries as well, resampled
    but not cleaned. Intermediate tables are deleted at the end, whether the build succeeds or not; readers see the old
    mart until the new one is complete.
    """
    with scratch_scope(spark):
        recordings = load_recordings(spark, raw_dir, registry, extra_columns)
        cleaned = clean_series(recordings.signals, KEYS, cleaning, SOURCE_ORDER, keep_extra=bool(extra_columns))
        cleaned = materialize(cleaned, "cleaned")
        table = materialize(
            enrich(
                recordings.metadata,
                quality_report(recordings.signals, cleaned, KEYS, cleaning),
                derived_features(cleaned, KEYS, features, index="_k"),
                processed_at,
            ),
            "metadata",
        )
        facts = cleaned.drop("outlier_mask")
        paths = write_mart(table, facts, mart, processed_at, index="_k", errors=recordings.errors)
    return MartBuild(paths, read_errors(spark, mart.output_dir), verify_mart(spark, mart.output_dir))


def verify_mart(spark: SparkSession, mart_dir: str, shots: int = 3) -> dict:
    """Read back what was written: counts, the first recordings' points, columns and size."""
    table = read_metadata(spark, mart_dir)
    first = [r.shot_id for r in table.select("shot_id").orderBy("shot_id").limit(shots).collect()]
    facts = read_signals(spark, mart_dir, first)
    return {
        "n_shots": table.count(),
        "sample_ids": first,
        "sample_points": facts.agg(F.count(F.lit(1))).first()[0],
        "signal_columns": facts.columns,
        "size_mb": mart_size_mb(spark, mart_dir),
    }
