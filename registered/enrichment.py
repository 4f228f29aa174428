from __future__ import annotations

from pyspark.sql import functions as F

from registered.inputs import (
    SHOT, SUPPLIER_SERIES_SQL, USER_SERIES_SQL, rounded, supplier_series, table, user_mart_table,
    user_series,
)
from registered.sql import META, exactly, features_sql
from tidegrid.config import MartConfig
from tidegrid.operators.enrich import PREVIEW, agreement, confusion, preview, sort_metadata
from tidegrid.operators.features import derived_features, detect_disruption, duration_and_peak
from tidegrid.session import scratch_dir
from tidegrid.sinks.mart import MANIFEST, flag_counts, manifest_statistics, write_manifest

_META = f"WITH {META}"


def duration_peak(spark, sf_dir):
    return rounded(duration_and_peak(user_series(spark, sf_dir), SHOT))


def plateau_means(spark, sf_dir):
    return features(spark, sf_dir).select(
        "shot_id", "plasma_current_mean_MA", "electron_density_mean", "electron_temperature_mean"
    )


def features(spark, sf_dir):
    return rounded(derived_features(supplier_series(spark, sf_dir), SHOT, index="_i", rounded=False))


def disruption(spark, sf_dir):
    return rounded(detect_disruption(supplier_series(spark, sf_dir), SHOT, index="_i"))


def enriched(spark, sf_dir):
    return user_mart_table(spark, sf_dir).drop("processed_at_utc")


def agree(spark, sf_dir):
    return rounded(agreement(user_mart_table(spark, sf_dir)))


def confusion_matrix(spark, sf_dir):
    return confusion(user_mart_table(spark, sf_dir))


def statistics(spark, sf_dir):
    return manifest_statistics(user_mart_table(spark, sf_dir))


def previewed(spark, sf_dir):
    """The sorted dimension table in its preview columns, whole."""
    table = sort_metadata(user_mart_table(spark, sf_dir))
    return preview(table, rows=None)


def manifest_flags(spark, sf_dir):
    """Counts of more kinds of flags than fit a short list."""
    return flag_counts(_many_flags(spark, sf_dir))


def _many_flags(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_custkey").alias("shot_id"),
        F.concat(F.lit("flag"), (F.col("c_custkey") % 120).cast("string")).alias("quality_flag"),
        (F.col("c_custkey") % 16 == 0).alias("declared_disruption"),
        (F.col("c_custkey") % 3 == 0).alias("disruption_detected"),
        (F.col("c_acctbal") / 10000).alias("overall_completeness"),
    )


def manifest_document(spark, sf_dir):
    """The written manifest, read back: one row for each of its flags."""
    path = scratch_dir(spark, "manifest")
    write_manifest(_many_flags(spark, sf_dir), MartConfig(path), "2026-01-01T00:00:00+00:00")
    kind = (
        "statistics struct<total_shots: bigint, disruption_rate_declared: double, disruption_rate_detected: double,"
        " mean_completeness: double, quality_flags: map<string, bigint>>, tables struct<metadata: struct<columns: array<string>>>"
    )
    card = spark.read.text(f"{path}/{MANIFEST}", wholetext=True).select(F.from_json("value", kind).alias("c"))
    card = card.select("c.statistics.*", F.size("c.tables.metadata.columns").alias("n_columns"))
    rest = [c for c in card.columns if c != "quality_flags"]
    return card.select(*rest, F.explode("quality_flags").alias("quality_flag", "n_shots"))


QUERIES = {
    "meta_preview": previewed,
    "mart_manifest_flags": manifest_flags,
    "mart_manifest_doc": manifest_document,
    "feat_duration_peak": duration_peak,
    "feat_plateau_means": plateau_means,
    "feat_disruption": disruption,
    "feat_all": features,
    "meta_enrich": enriched,
    "meta_agreement": agree,
    "meta_confusion": confusion_matrix,
    "mart_manifest_stats": statistics,
}

_SUPPLIER_FEATURES = f"WITH {SUPPLIER_SERIES_SQL}, {features_sql('series', 'i', 'round({}, 6)'.format)}"

ORACLES = {
    "feat_duration_peak": f"""WITH {USER_SERIES_SQL}
SELECT shot_id, round(max(time_s) - min(time_s), 6) AS duration_effective_s, count(*) AS n_samples,
       round(max(plasma_current_MA), 6) AS plasma_current_max_MA FROM series GROUP BY shot_id""",
    "feat_plateau_means": _SUPPLIER_FEATURES
    + " SELECT shot_id, plasma_current_mean_MA, electron_density_mean, electron_temperature_mean FROM features",
    "feat_disruption": _SUPPLIER_FEATURES
    + """ SELECT shot_id, round(drop_time, 6) AS disruption_time_s, drop_time IS NOT NULL AS disruption_detected
FROM scale LEFT JOIN drops USING (shot_id)""",
    "feat_all": _SUPPLIER_FEATURES + " SELECT * FROM features",
    "meta_enrich": f"{_META} SELECT * FROM meta",
    "meta_agreement": f"""{_META} SELECT count(*) AS n_shots, count(*) FILTER (declared_disruption) AS n_declared,
  count(*) FILTER (disruption_detected) AS n_detected,
  count(*) FILTER (declared_disruption = disruption_detected) AS n_agree,
  round(avg(overall_completeness), 6) AS mean_completeness FROM meta""",
    "meta_confusion": f"""{_META} SELECT declared_disruption, disruption_detected, count(*) AS n_shots
FROM meta GROUP BY ALL""",
    "mart_manifest_stats": f"""{_META} SELECT count(*) AS total_shots,
  any_value(a) AS disruption_rate_declared, any_value(b) AS disruption_rate_detected,
  any_value(c) AS mean_completeness FROM meta, (
    SELECT {exactly('a', 3)} AS a, {exactly('b', 3)} AS b, {exactly('c', 4)} AS c FROM (
      SELECT avg(CAST(declared_disruption AS INTEGER)) AS a, avg(CAST(disruption_detected AS INTEGER)) AS b,
             avg(overall_completeness) AS c FROM meta))""",
    "meta_preview": f"{_META} SELECT {', '.join(PREVIEW)} FROM meta",
    "mart_manifest_flags": """SELECT 'flag' || c_custkey % 120 AS quality_flag, count(*) AS n_shots
FROM customer GROUP BY ALL""",
    "mart_manifest_doc": f"""SELECT total_shots, {exactly('a', 3)} AS disruption_rate_declared,
  {exactly('b', 3)} AS disruption_rate_detected, {exactly('c', 4)} AS mean_completeness,
  CAST(5 AS INTEGER) AS n_columns, quality_flag, n_shots
FROM (SELECT count(*) AS total_shots, avg(CAST(c_custkey % 16 = 0 AS INTEGER)) AS a,
             avg(CAST(c_custkey % 3 = 0 AS INTEGER)) AS b, avg(c_acctbal / 10000) AS c FROM customer),
     (SELECT 'flag' || c_custkey % 120 AS quality_flag, count(*) AS n_shots FROM customer GROUP BY ALL)""",
}
