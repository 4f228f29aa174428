"""The result tables behind the standard charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import SIGNAL_COLUMNS, TIME_COLUMN
from tidegrid.operators.enrich import SENSORS
from tidegrid.sources.mart import read_metadata, read_signals

# Line colours by quality flag.
FLAG_COLOURS = {"OK": "#2ca02c", "DEGRADED": "#ff7f0e", "REJECTED": "#d62728"}
OTHER_COLOUR = "#999999"
HISTOGRAM_BINS = 30


def event_markers(metadata: DataFrame) -> DataFrame:
    """Recordings with a detected event at a time other than zero."""
    time = F.col("disruption_time_detected_s")
    return metadata.where(F.col("disruption_detected") & (time != 0)).select(
        "shot_id", time.alias("event_time_s")
    )


def shot_detail(signals: DataFrame, metadata: DataFrame, shot_id: int) -> DataFrame:
    """One recording in long form with its context and event marker; empty if it is unknown."""
    shot = F.col("shot_id") == shot_id
    facts = signals.where(shot).unpivot(
        ["shot_id", TIME_COLUMN], list(SIGNAL_COLUMNS), "signal", "value"
    )
    about = metadata.where(shot).select(
        "shot_id", "machine_config", "quality_flag", "overall_completeness"
    )
    markers = event_markers(metadata.where(shot))
    return (
        facts.join(about, "shot_id").join(markers, "shot_id", "left").orderBy("signal", TIME_COLUMN)
    )


def flag_distribution(metadata: DataFrame) -> DataFrame:
    return (
        metadata.where("quality_flag is not null")
        .groupBy("quality_flag")
        .agg(F.count(F.lit(1)).alias("n_shots"))
        .orderBy(F.desc("n_shots"), "quality_flag")
    )


def sensor_completeness(metadata: DataFrame) -> DataFrame:
    """Mean completeness of each sensor in percent."""
    names = [short for short, _ in SENSORS]
    means = metadata.agg(*[(F.avg(f"completeness_{s}") * 100).alias(s) for s in names])
    return means.unpivot([], names, "sensor", "mean_completeness_pct")


def rate_by_group(
    metadata: DataFrame, group: str = "machine_config", event: str = "declared_disruption"
) -> DataFrame:
    """Events, recordings with a known event state, and their ratio in percent per group."""
    return (
        metadata.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count_if(event).alias("n_events"), F.count(event).alias("n_shots"))
        .withColumn(
            "rate_pct",
            F.when(F.col("n_shots") > 0, F.col("n_events") / F.col("n_shots") * 100),
        )
    )


def histogram(df: DataFrame, value: Column, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in ``bins`` equal-width bins; the maximum belongs to the last one.

    Two scalars, the minimum and the maximum, are fetched first.
    """
    values = df.select(value.cast("double").alias("value")).where("value is not null")
    lo, hi = values.agg(F.min("value"), F.max("value")).first()
    if lo is None or lo == hi:
        bucket, width = F.lit(1), 0.0
    else:
        width = (hi - lo) / bins
        bucket = F.least(
            F.width_bucket("value", F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)
        )
    low = 0.0 if lo is None else lo
    return (
        values.groupBy(bucket.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(low) + (F.col("bin") - 1) * F.lit(width))
    )


def completeness_histogram(metadata: DataFrame) -> DataFrame:
    return histogram(metadata, F.col("overall_completeness") * 100)


def series_label() -> Column:
    tag = F.when(F.col("declared_disruption"), ", disrupt").otherwise("")
    return F.concat(F.lit("Shot "), "shot_id", F.lit(" ("), "quality_flag", tag, F.lit(")"))


def flag_colour() -> Column:
    pairs = [F.lit(x) for item in FLAG_COLOURS.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[F.col("quality_flag")], F.lit(OTHER_COLOUR))


def comparison(
    signals: DataFrame,
    metadata: DataFrame,
    shot_ids: Sequence[int],
    signal: str = SIGNAL_COLUMNS[0],
) -> DataFrame:
    """One signal of several recordings, in the caller's order; unknown recordings are left out."""
    ids = [int(i) for i in shot_ids]
    chosen = F.col("shot_id").isin(ids)
    about = metadata.where(chosen).select(
        "shot_id", series_label().alias("label"), flag_colour().alias("colour")
    )
    position = F.array_position(F.array(*[F.lit(i).cast("long") for i in ids]), F.col("shot_id").cast("long"))
    return (
        signals.where(chosen)
        .select("shot_id", TIME_COLUMN, F.col(signal).alias("value"))
        .join(about, "shot_id")
        .withColumn("position", position)
        .orderBy("position", TIME_COLUMN)
    )


def default_shot(metadata: DataFrame) -> DataFrame:
    """The first recording with a declared event, else the first one."""
    declared = F.coalesce(F.col("declared_disruption"), F.lit(False))
    return metadata.orderBy(F.desc(declared), "shot_id").limit(1).select("shot_id")


def first_disrupted(metadata: DataFrame, n: int = 10) -> DataFrame:
    return metadata.where("declared_disruption").orderBy("shot_id").limit(n).select("shot_id")


def write_standard_reports(spark: SparkSession, mart_dir: str, out_dir: str) -> dict[str, str]:
    """Write every report table of a mart; returns their paths."""
    metadata = read_metadata(spark, mart_dir)
    tables = {
        "flag_distribution": flag_distribution(metadata),
        "sensor_completeness": sensor_completeness(metadata),
        "rate_by_machine_config": rate_by_group(metadata),
        "completeness_histogram": completeness_histogram(metadata),
    }
    shot = default_shot(metadata).first()
    if shot:
        facts = read_signals(spark, mart_dir, [shot.shot_id])
        tables["shot_detail"] = shot_detail(facts, metadata, shot.shot_id)
    ids = [r.shot_id for r in first_disrupted(metadata).collect()]
    if ids:
        facts = read_signals(spark, mart_dir, ids)
        tables["shots_comparison"] = comparison(facts, metadata, ids)
    paths = {name: f"{out_dir}/{name}.parquet" for name in tables}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(paths[name])
    return paths
