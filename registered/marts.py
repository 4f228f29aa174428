from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registered.inputs import (
    SIGNALS, SUPPLIER_SERIES_SQL, rounded, supplier_facts, supplier_series, table, user_mart,
)
from registered.sql import META
from tidegrid.config import MartConfig
from tidegrid.plans import reports
from tidegrid.session import scratch_dir
from tidegrid.sinks.mart import write_metadata, write_signals
from tidegrid.sources import mart

_COLUMNS = "shot_id, time_s, " + ", ".join(f"round({s}, 6) AS {s}" for s in SIGNALS)
_FACTS = f"WITH {SUPPLIER_SERIES_SQL} SELECT {_COLUMNS} FROM series"
_META = f"WITH {META}"
_SOME = [1, 5, 7]
BIG = 3_000_000_000


def write_read(spark, sf_dir):
    path = scratch_dir(spark, "facts")
    write_signals(supplier_series(spark, sf_dir).drop("_i"), MartConfig(path, compression="zstd"))
    return rounded(mart.read_signals(spark, path))


def pruned_read(spark, sf_dir):
    return rounded(mart.read_signals(spark, supplier_facts(spark, sf_dir), _SOME))


def overwrite_dynamic(spark, sf_dir):
    """Write all suppliers, then replace those with a negative balance and keep the others."""
    path = scratch_dir(spark, "facts")
    facts = supplier_series(spark, sf_dir).drop("_i")
    write_signals(facts, MartConfig(path))
    supplier = table(spark, sf_dir, "supplier").where("s_acctbal < 0")
    again = facts.join(supplier, F.col("shot_id") == F.col("s_suppkey"), "left_semi")
    doubled = again.withColumn("plasma_current_MA", F.col("plasma_current_MA") * 2)
    write_signals(doubled, MartConfig(path, overwrite=False))
    return rounded(mart.read_signals(spark, path))


def semi_select(spark, sf_dir):
    """Facts of the suppliers that a condition on the dimension table selects."""
    path = supplier_facts(spark, sf_dir)
    dimension = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("shot_id"), "s_acctbal", "s_nationkey"
    )
    write_metadata(dimension, MartConfig(path))
    return rounded(mart.select_signals(spark, path, "s_acctbal > 5000 and s_nationkey < 10"))


def semi_select_flag(spark, sf_dir):
    """The same by a bare truth value."""
    path = supplier_facts(spark, sf_dir)
    dimension = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("shot_id"), (F.col("s_nationkey") % 2 == 0).alias("chosen")
    )
    write_metadata(dimension, MartConfig(path))
    return rounded(mart.select_signals(spark, path, "chosen"))


def shared_directories(spark, sf_dir):
    """Several recordings in a directory, read as a whole."""
    path = scratch_dir(spark, "facts")
    write_signals(supplier_series(spark, sf_dir).drop("_i"), MartConfig(path, shots_per_directory=8))
    return rounded(mart.read_signals(spark, path))


def extra_columns(spark, sf_dir):
    """A column beyond the canonical ones comes back as it was written."""
    path = scratch_dir(spark, "facts")
    facts = supplier_series(spark, sf_dir).withColumn("place", F.col("_i") * 2).drop("_i")
    write_signals(facts, MartConfig(path))
    return rounded(mart.read_signals(spark, path))


def comparison_long_ids(spark, sf_dir):
    """The comparison of recordings whose ids need 64 bits."""
    dimension = _supplier_dimension(spark, sf_dir).withColumn("shot_id", F.col("shot_id") + BIG)
    facts = supplier_series(spark, sf_dir).drop("_i").withColumn("shot_id", F.col("shot_id") + BIG)
    shots = [r.shot_id for r in reports.first_disrupted(dimension).collect()]
    return rounded(reports.comparison(facts, dimension, shots))


def standard_set(spark, sf_dir):
    """Rows of every table of the report set."""
    paths = reports.write_standard_reports(spark, user_mart(spark, sf_dir), scratch_dir(spark, "reports"))
    counts = [
        spark.read.parquet(path).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
        for name, path in sorted(paths.items())
    ]
    return reduce(DataFrame.unionAll, counts)


def _meta(spark, sf_dir):
    return mart.read_metadata(spark, user_mart(spark, sf_dir))


def _facts(spark, sf_dir):
    return mart.read_signals(spark, user_mart(spark, sf_dir))


def flag_dist(spark, sf_dir):
    return reports.flag_distribution(_meta(spark, sf_dir))


def sensors(spark, sf_dir):
    return rounded(reports.sensor_completeness(_meta(spark, sf_dir)))


def rates(spark, sf_dir):
    return rounded(reports.rate_by_group(_meta(spark, sf_dir)))


def histogram(spark, sf_dir):
    return rounded(reports.histogram(table(spark, sf_dir, "orders"), F.col("o_totalprice")), 4)


def completeness_histogram(spark, sf_dir):
    return rounded(reports.completeness_histogram(_meta(spark, sf_dir)), 4)


def markers(spark, sf_dir):
    return reports.event_markers(_meta(spark, sf_dir))


def _supplier_dimension(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("shot_id"),
        F.col("s_name").alias("machine_config"),
        F.when(F.col("s_acctbal") > 5000, "OK").when(F.col("s_acctbal") > 0, "DEGRADED")
        .otherwise("REJECTED").alias("quality_flag"),
        (F.col("s_acctbal") / 10000).alias("overall_completeness"),
        (F.col("s_nationkey") % 2 == 0).alias("declared_disruption"),
        (F.col("s_nationkey") % 2 == 0).alias("disruption_detected"),
        (F.col("s_nationkey") / 2).alias("disruption_time_detected_s"),
    )


_DIMENSION = """dimension AS (
  SELECT s_suppkey AS shot_id, s_name AS machine_config,
         CASE WHEN s_acctbal > 5000 THEN 'OK' WHEN s_acctbal > 0 THEN 'DEGRADED' ELSE 'REJECTED' END
           AS quality_flag,
         s_acctbal / 10000 AS overall_completeness, s_nationkey % 2 = 0 AS declared_disruption,
         s_nationkey / 2e0 AS event_time
  FROM supplier)"""


def shot_detail(spark, sf_dir):
    dimension = _supplier_dimension(spark, sf_dir)
    shot = reports.default_shot(dimension).first().shot_id
    facts = mart.read_signals(spark, supplier_facts(spark, sf_dir), [shot])
    return rounded(reports.shot_detail(facts, dimension, shot))


def comparison(spark, sf_dir):
    dimension = _supplier_dimension(spark, sf_dir)
    shots = [r.shot_id for r in reports.first_disrupted(dimension).collect()]
    facts = mart.read_signals(spark, supplier_facts(spark, sf_dir), shots)
    return rounded(reports.comparison(facts, dimension, shots))


def default_shot(spark, sf_dir):
    return reports.default_shot(_meta(spark, sf_dir))


def top10(spark, sf_dir):
    return reports.first_disrupted(_meta(spark, sf_dir))


QUERIES = {
    "mart_semi_select_flag": semi_select_flag,
    "mart_shared_directories": shared_directories,
    "mart_extra_columns": extra_columns,
    "rep_comparison_long_ids": comparison_long_ids,
    "rep_standard_set": standard_set,
    "mart_write_read": write_read,
    "mart_pruned_read": pruned_read,
    "mart_overwrite_dynamic": overwrite_dynamic,
    "mart_semi_select": semi_select,
    "rep_flag_dist": flag_dist,
    "rep_sensor_completeness": sensors,
    "rep_rate_by_group": rates,
    "rep_histogram": histogram,
    "rep_completeness_histogram": completeness_histogram,
    "rep_event_markers": markers,
    "rep_shot_detail": shot_detail,
    "rep_comparison": comparison,
    "rep_default_shot": default_shot,
    "rep_top10": top10,
}


def _histogram_sql(source: str, value: str) -> str:
    """Bin edges accumulate like the query's; the maximum is moved into the last bin."""
    return f"""v AS (SELECT {value} AS x FROM {source} WHERE {value} IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT CAST(CASE WHEN lo = hi THEN 1 ELSE least(30, floor(30 * (x - lo) / (hi - lo)) + 1) END AS INTEGER) AS bin,
       count(*) AS n, round(any_value(lo) + (bin - 1) * ((any_value(hi) - any_value(lo)) / 30), 4) AS bin_start
FROM v, b GROUP BY bin"""


ORACLES = {
    "mart_write_read": _FACTS,
    "mart_pruned_read": f"{_FACTS} WHERE shot_id IN (1, 5, 7)",
    "mart_overwrite_dynamic": f"""WITH {SUPPLIER_SERIES_SQL}
SELECT shot_id, time_s,
       round(CASE WHEN s_acctbal < 0 THEN plasma_current_MA * 2 ELSE plasma_current_MA END, 6)
         AS plasma_current_MA,
       {", ".join(f"round({s}, 6) AS {s}" for s in SIGNALS[1:])}
FROM series LEFT JOIN supplier ON s_suppkey = shot_id""",
    "mart_semi_select": f"""{_FACTS} WHERE EXISTS (
  SELECT 1 FROM supplier WHERE s_suppkey = shot_id AND s_acctbal > 5000 AND s_nationkey < 10)""",
    "rep_flag_dist": f"{_META} SELECT quality_flag, count(*) AS n_shots FROM meta GROUP BY quality_flag",
    "rep_sensor_completeness": f"""{_META} """
    + " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, round(avg(completeness_{s}) * 100, 6) AS mean_completeness_pct FROM meta"
        for s in ("plasma_current", "density", "temperature", "vloop")
    ),
    "rep_rate_by_group": f"""{_META} SELECT machine_config, count(*) FILTER (declared_disruption) AS n_events,
  count(declared_disruption) AS n_shots,
  round(count(*) FILTER (declared_disruption) / count(declared_disruption) * 100, 6) AS rate_pct
FROM meta WHERE machine_config IS NOT NULL GROUP BY machine_config""",
    "rep_histogram": "WITH " + _histogram_sql("orders", "o_totalprice"),
    "rep_completeness_histogram": f"{_META}, " + _histogram_sql("meta", "overall_completeness * 100"),
    "rep_event_markers": f"""{_META} SELECT shot_id, disruption_time_detected_s AS event_time_s FROM meta
WHERE disruption_detected AND disruption_time_detected_s <> 0""",
    "rep_shot_detail": f"""WITH {SUPPLIER_SERIES_SQL}, {_DIMENSION},
chosen AS (SELECT * FROM dimension ORDER BY declared_disruption DESC, shot_id LIMIT 1),
long AS (
"""
    + " UNION ALL ".join(
        f"SELECT shot_id, time_s, '{s}' AS signal, {s} AS value FROM series"
        for s in ("plasma_current_MA", "electron_density", "electron_temperature", "loop_voltage")
    )
    + """)
SELECT shot_id, time_s, signal, round(value, 6) AS value, machine_config, quality_flag,
       round(overall_completeness, 6) AS overall_completeness,
       round(CASE WHEN declared_disruption AND event_time <> 0 THEN event_time END, 6) AS event_time_s
FROM long JOIN chosen USING (shot_id)""",
    "rep_comparison": f"""WITH {SUPPLIER_SERIES_SQL}, {_DIMENSION},
chosen AS (SELECT *, row_number() OVER (ORDER BY shot_id) AS position FROM dimension
           WHERE declared_disruption ORDER BY shot_id LIMIT 10)
SELECT shot_id, time_s, round(plasma_current_MA, 6) AS value,
       'Shot ' || shot_id || ' (' || quality_flag || ', disrupt)' AS label,
       CASE quality_flag WHEN 'OK' THEN '#2ca02c' WHEN 'DEGRADED' THEN '#ff7f0e' ELSE '#d62728' END AS colour,
       position
FROM series JOIN chosen USING (shot_id)""",
    "mart_semi_select_flag": f"""{_FACTS} WHERE EXISTS (
  SELECT 1 FROM supplier WHERE s_suppkey = shot_id AND s_nationkey % 2 = 0)""",
    "mart_shared_directories": _FACTS,
    "mart_extra_columns": f"WITH {SUPPLIER_SERIES_SQL} SELECT {_COLUMNS}, i * 2 AS place FROM series",
    "rep_standard_set": f"""{_META},
first AS (SELECT shot_id FROM meta ORDER BY declared_disruption DESC, shot_id LIMIT 1),
ten AS (SELECT shot_id FROM meta WHERE declared_disruption ORDER BY shot_id LIMIT 10),
v AS (SELECT overall_completeness * 100 AS x FROM meta), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT 'flag_distribution' AS report, count(DISTINCT quality_flag) AS n_rows FROM meta
UNION ALL SELECT 'sensor_completeness', 4
UNION ALL SELECT 'rate_by_machine_config', count(DISTINCT machine_config) FROM meta
UNION ALL SELECT 'completeness_histogram', count(DISTINCT CASE WHEN lo = hi THEN 1
  ELSE least(30, floor(30 * (x - lo) / (hi - lo)) + 1) END) FROM v, e
UNION ALL SELECT 'shot_detail', 4 * count(*) FROM cleaned JOIN first USING (shot_id)
UNION ALL SELECT 'shots_comparison', count(*) FROM cleaned JOIN ten USING (shot_id)""",
    "rep_default_shot": f"{_META} SELECT shot_id FROM meta ORDER BY declared_disruption DESC, shot_id LIMIT 1",
    "rep_top10": f"{_META} SELECT shot_id FROM meta WHERE declared_disruption ORDER BY shot_id LIMIT 10",
}
ORACLES["rep_comparison_long_ids"] = f"""SELECT * REPLACE (shot_id + {BIG} AS shot_id,
  replace(label, 'Shot ' || shot_id || ' ', 'Shot ' || (shot_id + {BIG}) || ' ') AS label)
FROM ({ORACLES["rep_comparison"]})"""
