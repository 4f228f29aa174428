"""The driver tables as multi-sensor series, in Spark and in SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import SIGNAL_COLUMNS, CleaningConfig, MartConfig
from tidegrid.operators.clean import clean_series
from tidegrid.operators.enrich import enrich
from tidegrid.operators.features import derived_features
from tidegrid.operators.quality import quality_report
from tidegrid.operators.series import with_row_index
from tidegrid.session import materialize, scratch_dir
from tidegrid.sinks.mart import write_mart, write_signals

ORIGIN_MICROS = 1704067200000000  # 2024-01-01T00:00:00Z
HZ = 1 / 21600  # four grid points a day
SHOT = ["shot_id"]
SIGNALS = list(SIGNAL_COLUMNS)
# A short window and a low threshold, so that series of about 120 points have outliers and gaps.
CLEANING = CleaningConfig(
    target_sampling_hz=HZ, outlier_mad_threshold=3.0, mad_window=21, max_gap_to_impute=1
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places, but times as they are: both sides compute them alike."""
    measured = {c for c, kind in df.dtypes if kind == "double" and c != "time_s"}
    return df.select(
        *[F.round(c, digits).alias(c) if c in measured else F.col(c) for c in df.columns]
    )


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One four-signal recording per user, with injected gaps and some dead sensors."""
    e, value = F.col("event_id"), F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("shot_id"),
        ((F.unix_micros(F.col("ts").cast("timestamp")) - ORIGIN_MICROS) / 1e6).alias("time_s"),
        "event_id",
        F.when(e % 37 >= 3, value / 100).alias("plasma_current_MA"),
        F.when(e % 11 != 0, value * 0.5).alias("electron_density"),
        ((e % 97) / 10.0).alias("electron_temperature"),
        F.when(F.col("user_id") % 7 != 0, (e % 13) * 0.1).alias("loop_voltage"),
    )


USER_SERIES_SQL = f"""series AS (
  SELECT user_id AS shot_id, (epoch_us(ts) - {ORIGIN_MICROS}) / 1e6 AS time_s, event_id,
         CASE WHEN event_id % 37 >= 3 THEN value / 100 END AS plasma_current_MA,
         CASE WHEN event_id % 11 <> 0 THEN value * 0.5e0 END AS electron_density,
         (event_id % 97) / 10e0 AS electron_temperature,
         CASE WHEN user_id % 7 <> 0 THEN (event_id % 13) * 1e-1 END AS loop_voltage
  FROM events)"""


def type_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long signal per event type; a fixed share of the values and one long run are missing."""
    return table(spark, sf_dir, "events").select(
        "event_type", "ts", "event_id", F.when(~_missing(), F.col("value")).alias("v")
    )


def _missing():
    e = F.col("event_id")
    return (e % 37 < 3) | (F.floor(e / 1000) % 4 == 2)


TYPE_SERIES_SQL = """series AS (
  SELECT event_type, ts, event_id,
         CASE WHEN NOT (event_id % 37 < 3 OR (event_id // 1000) % 4 = 2) THEN value END AS v
  FROM events)"""


def supplier_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recording per supplier, its lines in shipping order, a millisecond apart.

    Division by sevens keeps means of the values off decimal ties.
    """
    lines = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return with_row_index(lines, ["l_suppkey"], order).select(
        F.col("l_suppkey").alias("shot_id"),
        "_i",
        (F.col("_i") * 0.001).alias("time_s"),
        (F.col("l_extendedprice") / 7000).alias("plasma_current_MA"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity") / 7).alias("electron_density"),
        (F.col("l_discount") / 7).alias("electron_temperature"),
        (F.col("l_tax") / 7).alias("loop_voltage"),
    )


SUPPLIER_SERIES_SQL = """series AS (
  SELECT l_suppkey AS shot_id, i, i * 1e-3 AS time_s, l_extendedprice / 7000 AS plasma_current_MA,
         CASE WHEN l_linenumber <> 3 THEN l_quantity / 7 END AS electron_density,
         l_discount / 7 AS electron_temperature, l_tax / 7 AS loop_voltage
  FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
          ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS i
        FROM lineitem))"""


def user_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata record per user, described by the customer of the same number."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("shot_id")).distinct()
    customer = table(spark, sf_dir, "customer")
    s = F.col("shot_id")
    naming = F.element_at(F.array(*map(F.lit, ("canonical", "raw", "verbose"))), (s % 3 + 1).cast("int"))
    unit = F.when(s % 2 == 0, "MA").otherwise("A")
    return users.join(customer, s == F.col("c_custkey"), "left").select(
        "shot_id",
        F.col("c_name").alias("operator"),
        F.col("c_mktsegment").alias("machine_config"),
        F.when(s % 4 == 0, "json").otherwise("csv").alias("file_format"),
        unit.alias("current_unit"),
        naming.alias("column_naming_scheme"),
        F.lit(1).alias("sampling_hz"),
        (s % 5 == 0).alias("disruption"),
        F.when(s % 5 == 0, s * 1.5).alias("disruption_time_s"),
        F.lit(2592000.0).alias("duration_s"),
        F.concat_ws("_", naming, unit).alias("schema_applied"),
    )


USER_METADATA_SQL = """described AS (
  SELECT user_id AS shot_id, c_name AS operator, c_mktsegment AS machine_config,
         CASE WHEN user_id % 4 = 0 THEN 'json' ELSE 'csv' END AS source_format,
         CASE WHEN user_id % 2 = 0 THEN 'MA' ELSE 'A' END AS source_current_unit,
         CASE user_id % 3 WHEN 0 THEN 'canonical' WHEN 1 THEN 'raw' ELSE 'verbose' END
           AS source_column_naming,
         CAST(1 AS INTEGER) AS source_sampling_hz, user_id % 5 = 0 AS declared_disruption,
         CASE WHEN user_id % 5 = 0 THEN user_id * 1.5e0 END AS declared_disruption_time_s,
         2592000e0 AS declared_duration_s
  FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN customer ON c_custkey = user_id)"""


def cleaned_users(spark: SparkSession, sf_dir: str, **changes) -> DataFrame:
    return clean_series(
        user_series(spark, sf_dir), SHOT, replace(CLEANING, **changes), tie=["event_id"]
    )


def user_mart_table(spark: SparkSession, sf_dir: str, cleaned: DataFrame | None = None) -> DataFrame:
    raw = user_series(spark, sf_dir)
    if cleaned is None:
        cleaned = materialize(cleaned_users(spark, sf_dir), "cleaned")
    return enrich(
        user_metadata(spark, sf_dir),
        quality_report(raw, cleaned, SHOT, CLEANING),
        derived_features(cleaned, SHOT, index="_k"),
        processed_at="2024-02-01T00:00:00+00:00",
    )


_written: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """A mart that several queries read is written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def user_mart(spark: SparkSession, sf_dir: str) -> str:
    """The mart of the cleaned user recordings, which the reports read."""

    def write(path):
        cleaned = materialize(cleaned_users(spark, sf_dir), "cleaned")
        dimension = materialize(user_mart_table(spark, sf_dir, cleaned), "metadata")
        write_mart(dimension, cleaned.drop("outlier_mask"), MartConfig(path), index="_k")

    return _once(spark, sf_dir, "usermart", write)


def supplier_facts(spark: SparkSession, sf_dir: str) -> str:
    """A fact table of the supplier recordings."""

    def write(path):
        write_signals(supplier_series(spark, sf_dir).drop("_i"), MartConfig(path))

    return _once(spark, sf_dir, "supplierfacts", write)
