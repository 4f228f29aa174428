from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registered.inputs import CLEANING, ORIGIN_MICROS, _once, rounded, table, user_mart
from registered.sql import GRID, META, exactly
from tidegrid.config import MartConfig
from tidegrid.files import replace_text
from tidegrid.plans.build import build_mart
from tidegrid.plans.ml import cross_validate, rank_auc, stratified_folds
from tidegrid.session import scratch_dir
from tidegrid.sources import mart
from tidegrid.sources import recordings as rec
from tidegrid.sources.registry import CURRENT_UNITS, NAMING_SCHEMES, SourceRegistry

# Every event belongs to one of twelve recordings, one for each combination of naming scheme,
# current unit and file format.
LAYOUTS = [
    (naming, unit, kind)
    for kind in ("csv", "json")
    for unit in CURRENT_UNITS
    for naming in NAMING_SCHEMES
]
# Recordings that can't be read: one for each nation of the first two regions, broken in turn in one of these ways.
_BROKEN = [
    ("current_unit: kA", "unknown schema canonical_kA"),
    ("file_format: hdf5", "unsupported file format: hdf5"),
    ("current_unit:", "a metadata key of the schema name has no value"),
    ("machine_config: B", "missing columns"),
]
_FIRST_BROKEN = 9000
_BROKEN_SQL = f"""broken AS (
  SELECT printf('shot_%04d', {_FIRST_BROKEN} + n_nationkey) AS recording, CASE n_nationkey % {len(_BROKEN)} {
    " ".join(f"WHEN {i} THEN '{error}'" for i, (_, error) in enumerate(_BROKEN))} END AS error
  FROM nation WHERE n_regionkey < 2)"""


def _measures():
    e, value = F.col("event_id"), F.col("value")
    return [
        ((F.unix_micros(F.col("ts").cast("timestamp")) - ORIGIN_MICROS) / 1e6),
        value / 100,
        F.when(e % 11 != 0, value * 0.5),
        (e % 97) / 10.0,
        (e % 13) * 0.1,
    ]


def _metadata(shot, naming, unit, kind):
    return (
        f"shot_id: {shot}\nduration_s: 2592000.0\nsampling_hz: 1\n"
        f"disruption: {str(shot % 5 == 0).lower()}\ndisruption_time_s: null\n"
        f"file_format: {kind}\ncurrent_unit: {unit}\ncolumn_naming_scheme: {naming}\n"
        f"operator: Op{shot % 3}\nmachine_config: M{shot % 2}\n"
    )


def _write_text(spark, path, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def _raw_dir(spark, sf_dir):
    """All events as raw recordings: permuted headers, explicit nulls, an extra column."""

    def write(root):
        events = table(spark, sf_dir, "events").withColumn(
            "shot", F.pmod(F.col("user_id"), F.lit(len(LAYOUTS)))
        )
        for shot, (naming, unit, kind) in enumerate(LAYOUTS):
            values = _measures()
            values[1] = values[1] / CURRENT_UNITS[unit]
            columns = [v.alias(c) for v, c in zip(values, NAMING_SCHEMES[naming])]
            if shot % 2:
                columns = columns[::-1]
            if shot % 4 == 0:
                columns.insert(1, F.concat("event_type", F.lit('}, {"\\" ]{')).alias("note") if kind == "json" else F.col("event_type").alias("note"))
            mine = events.where(F.col("shot") == shot).select(*columns)
            folder = f"{root}/shot_{shot:04d}"
            if kind == "csv":
                mine.write.option("header", True).csv(f"{folder}/signals.csv")
            else:
                mine.write.option("ignoreNullFields", False).json(f"{folder}/signals.json")
            _write_text(spark, f"{folder}/metadata.yaml", _metadata(shot, naming, unit, kind))
        few = events.where("event_id < 4").select(*[m.alias(c) for m, c in zip(_measures()[:2], ("time_s", "plasma_current"))])
        rows = "".join(f"{r.time_s},{r.plasma_current}\n" for r in few.collect())
        nations = table(spark, sf_dir, "nation").where("n_regionkey < 2").select("n_nationkey").collect()
        for key in sorted(r.n_nationkey for r in nations):
            override, shot = _BROKEN[key % len(_BROKEN)][0], _FIRST_BROKEN + key
            field = override.split(":")[0]
            lines = _metadata(shot, "canonical", "MA", "csv").splitlines()
            text = "\n".join(override if line.startswith(field) else line for line in lines)
            replace_text(spark, f"{root}/shot_{shot:04d}/metadata.yaml", text)
            replace_text(spark, f"{root}/shot_{shot:04d}/signals.csv", f"time_s,plasma_current\n{rows}")

    return _once(spark, sf_dir, "raw", write)


_loaded: dict[str, rec.Recordings] = {}


def _load(spark, sf_dir):
    root = _raw_dir(spark, sf_dir)
    if root not in _loaded:
        _loaded[root] = rec.load_recordings(spark, root)
    return _loaded[root]


def roundtrip(spark, sf_dir):
    out = rec.load_recordings(spark, _raw_dir(spark, sf_dir))
    return rounded(out.signals.drop(*rec.SOURCE_ORDER))


def quarantine(spark, sf_dir):
    """Rows that each recording delivered, or the error that kept it out."""
    out = _load(spark, sf_dir)
    rows = out.signals.groupBy("shot_id").agg(F.count(F.lit(1)).alias("n_rows"))
    good = out.metadata.join(rows, "shot_id").select(
        "shot_dir", "n_rows", F.lit(None).cast("string").alias("error")
    )
    bad = out.errors.select(
        "shot_dir", F.lit(0).cast("long").alias("n_rows"), F.split("error", ";")[0].alias("error")
    )
    name = F.regexp_extract("shot_dir", "[^/]+$", 0)
    cut = F.regexp_replace("error", r"^missing columns .*$", "missing columns")
    return good.unionByName(bad).select(name.alias("recording"), "n_rows", cut.alias("error"))


def error_sample(spark, sf_dir):
    """The first errors by name, and how many there are."""
    errors = _load(spark, sf_dir).errors
    name = F.regexp_extract("shot_dir", "[^/]+$", 0).alias("recording")
    return rec.error_sample(errors).select(name, F.lit(errors.count()).cast("long").alias("n_errors"))


def usage(spark, sf_dir):
    return rec.schema_usage(_load(spark, sf_dir).metadata)


def summary(spark, sf_dir):
    return rec.dataset_summary(_load(spark, sf_dir).metadata)


def format_check(spark, sf_dir):
    """Whether the recordings of each machine, and all of them, come in one format."""
    metadata = _load(spark, sf_dir).metadata
    parts = [("all", metadata)] + [(m, metadata.where(F.col("machine_config") == m)) for m in ("M0", "M1")]
    checked = [rec.format_check(of).select(F.lit(name).alias("machine"), "n_shots", "is_homogeneous") for name, of in parts]
    return reduce(DataFrame.unionAll, checked).where("n_shots > 0")


def previewed(spark, sf_dir):
    """The first rows of the first recording, and its number of rows."""
    rows, n = rec.preview(_load(spark, sf_dir), 7)
    return rounded(rows.drop(*rec.SOURCE_ORDER)).withColumn("n_rows", F.lit(n).cast("long"))


def folds(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return stratified_folds(labels, "quality", "doc_id").select("doc_id", "quality", "fold")


def forest(spark, sf_dir):
    """Quality label of a document from simple measures of its whole text."""
    text = F.col("text")
    words = F.size(F.split(text, r"\s+"))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "n_chars",
        words.alias("n_words"),
        (F.col("n_chars") / words).alias("chars_per_word"),
        *[
            (F.length(F.regexp_replace(text, f"[^{kind}]", "")) / F.greatest(F.length(text), F.lit(1))).alias(name)
            for name, kind in (("digits", "0-9"), ("capitals", "A-Z"), ("marks", "!-/:-@"))
        ],
        (F.size(F.array_distinct(F.split(text, r"\s+"))) / words).alias("distinct_words"),
    )
    rows = table(spark, sf_dir, "labels").join(documents, "doc_id")
    return cross_validate(
        rows, "quality", "doc_id",
        ["n_chars", "n_words", "chars_per_word", "digits", "capitals", "marks", "distinct_words"],
        trees=20,
    )


def forest_check(spark, sf_dir):
    """Rows and positives of each fold, and whether the forest tells the labels apart on it."""
    return forest(spark, sf_dir).select("fold", "n_rows", "n_positive", (F.col("auc") > 0.8).alias("separates"))


def mart_forest(spark, sf_dir):
    """The event classifier on the mart's dimension table, cross-validated."""
    dimension = mart.read_metadata(spark, user_mart(spark, sf_dir))
    return cross_validate(dimension, "declared_disruption", "shot_id", trees=10)


def mart_auc(spark, sf_dir):
    """Rows, positives and exact AUC of each fold of the mart, the peak taken as score."""
    dimension = mart.read_metadata(spark, user_mart(spark, sf_dir))
    rows = stratified_folds(dimension, "declared_disruption", "shot_id")
    found = rank_auc(rows, F.col("declared_disruption"), "plasma_current_max_MA", "fold")
    return found.withColumn("auc", F.round("auc", 9))


def one_recording(spark, sf_dir):
    """A single recording, loaded by its directory."""
    shot = rec.load_recording(spark, f"{_raw_dir(spark, sf_dir)}/shot_0007")
    return rounded(shot.signals.drop(*rec.SOURCE_ORDER))


def yaml_registry(spark, sf_dir):
    """All recordings under a registry that a YAML text describes, with own names and factors."""
    registry = SourceRegistry.from_text(_REGISTRY)
    out = rec.load_recordings(spark, _raw_dir(spark, sf_dir), registry)
    return out.signals.groupBy("shot_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("current_kA"), 3).alias("sum_current")
    )


def build_verify(spark, sf_dir):
    """The whole way from raw recordings to a mart that is read back: points of every recording."""
    path = scratch_dir(spark, "mart")
    built = build_mart(
        spark, _raw_dir(spark, sf_dir), MartConfig(path), cleaning=CLEANING, processed_at="2026-01-01T00:00:00+00:00"
    )
    points = mart.read_signals(spark, path).groupBy("shot_id").agg(F.count(F.lit(1)).alias("n_points"))
    seen = built.verification
    sample = F.col("shot_id").isin([int(i) for i in seen["sample_ids"]])
    return mart.read_metadata(spark, path).join(points, "shot_id").select(
        "shot_id", "n_points", "n_samples_after_cleaning", sample.alias("in_sample"),
        F.lit(seen["n_shots"]).cast("long").alias("n_shots"), F.lit(seen["sample_points"]).cast("long").alias("sample_points"),
        F.lit(seen["size_mb"] > 0).alias("has_size"),
        F.lit(built.errors.count()).cast("long").alias("n_errors"),
    )


_REGISTRY = """
canonical_columns: {time: time_s, current: current_kA}
schemas:
  raw_A: {column_mapping: {t: time, Ip: current}, expected_columns: [t, Ip], unit_conversions: {current: 0.001}}
  verbose_MA: {column_mapping: {timestamp_seconds: time, Ip_plasma_MA: current}, expected_columns: [Ip_plasma_MA], unit_conversions: {current: 1000.0}}
resolution: {pattern: "{column_naming_scheme}_{current_unit}"}
"""

QUERIES = {
    "ingest_one": one_recording,
    "ingest_yaml_registry": yaml_registry,
    "mart_build_verify": build_verify,
    "ingest_mixed_roundtrip": roundtrip,
    "ingest_quarantine": quarantine,
    "ingest_error_sample": error_sample,
    "ingest_schema_usage": usage,
    "ingest_dataset_summary": summary,
    "ingest_format_check": format_check,
    "ml_stratified_folds": folds,
    "ml_rf_cv": forest,
    "ml_rf_cv_check": forest_check,
    "ml_rf_mart": mart_forest,
    "ml_mart_auc": mart_auc,
    "ingest_preview": previewed,
}

_SHOTS = """layouts AS (
  SELECT s AS shot_id,
         CASE s % 3 WHEN 0 THEN 'canonical' WHEN 1 THEN 'raw' ELSE 'verbose' END AS naming,
         CASE (s // 3) % 2 WHEN 0 THEN 'MA' ELSE 'A' END AS unit,
         CASE s // 6 WHEN 0 THEN 'csv' ELSE 'json' END AS kind
  FROM (SELECT DISTINCT user_id % 12 AS s FROM events))"""

_ROUNDTRIP = f"""SELECT user_id % 12 AS shot_id,
  (epoch_us(ts) - {ORIGIN_MICROS}) / 1e6 AS time_s, round(value / 100, 6) AS plasma_current_MA,
  round(CASE WHEN event_id % 11 <> 0 THEN value * 0.5e0 END, 6) AS electron_density,
  round((event_id % 97) / 10e0, 6) AS electron_temperature, round((event_id % 13) * 1e-1, 6) AS loop_voltage
FROM events"""

ORACLES = {
    "ingest_one": f"SELECT * FROM ({_ROUNDTRIP}) WHERE shot_id = 7",
    "ingest_yaml_registry": f"""WITH {_SHOTS}
SELECT shot_id, count(*) AS n_rows, round(sum(value * 10), 3) AS sum_current
FROM events JOIN layouts ON shot_id = user_id % 12
WHERE naming || '_' || unit IN ('raw_A', 'verbose_MA') GROUP BY shot_id""",
    "mart_build_verify": f"""WITH series AS (
  SELECT user_id % 12 AS shot_id, (epoch_us(ts) - {ORIGIN_MICROS}) / 1e6 AS time_s FROM events), {GRID},
ranked AS (SELECT shot_id, n_grid, row_number() OVER (ORDER BY shot_id) <= 3 AS in_sample FROM bounds)
SELECT shot_id, n_grid AS n_points, n_grid AS n_samples_after_cleaning, in_sample, count(*) OVER () AS n_shots,
  CAST(sum(CASE WHEN in_sample THEN n_grid END) OVER () AS BIGINT) AS sample_points, TRUE AS has_size,
  (SELECT count(*) FROM nation WHERE n_regionkey < 2) AS n_errors
FROM ranked""",
    "ingest_mixed_roundtrip": _ROUNDTRIP,
    "ingest_quarantine": f"""WITH {_BROKEN_SQL}
SELECT printf('shot_%04d', user_id % 12) AS recording, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS error
FROM events GROUP BY user_id % 12
UNION ALL SELECT recording, 0, error FROM broken""",
    "ingest_error_sample": f"""WITH {_BROKEN_SQL}
SELECT recording, (SELECT count(*) FROM broken) AS n_errors FROM broken ORDER BY recording LIMIT 5""",
    "ingest_preview": f"""SELECT *, (SELECT count(*) FROM events WHERE user_id % 12 = f.shot_id) AS n_rows
FROM ({_ROUNDTRIP}) f WHERE shot_id = (SELECT min(user_id % 12) FROM events) ORDER BY time_s LIMIT 7""",
    "ml_mart_auc": f"""WITH {META},
folds AS (SELECT declared_disruption AS d, plasma_current_max_MA AS x, CAST((row_number() OVER (
  PARTITION BY declared_disruption ORDER BY md5('42:' || shot_id), shot_id) - 1) % 5 AS INTEGER) AS fold FROM meta),
ranked AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY x) + (count(*) OVER (PARTITION BY fold, x) - 1) / 2 AS place
  FROM folds WHERE x IS NOT NULL),
sums AS (SELECT fold, count(*) AS n, count(*) FILTER (d) AS p, sum(place) FILTER (d) AS s FROM ranked GROUP BY fold)
SELECT fold, n AS n_rows, p AS n_positive, round((s - p * (p + 1) / 2) / nullif(p * (n - p), 0), 9) AS auc FROM sums""",
    "ingest_schema_usage": f"""WITH {_SHOTS}
SELECT naming || '_' || unit AS schema_applied, count(*) AS n_shots FROM layouts GROUP BY ALL""",
    "ingest_dataset_summary": f"""WITH {_SHOTS}
SELECT CASE grouping(kind, unit, naming) WHEN 7 THEN 'total' WHEN 3 THEN 'file_format'
         WHEN 5 THEN 'current_unit' ELSE 'column_naming_scheme' END AS dimension,
       coalesce(kind, unit, naming) AS value, count(*) AS n_shots,
       count(*) FILTER (shot_id % 5 = 0) AS n_disruptions,
       {exactly("(count(*) FILTER (shot_id % 5 = 0) / count(*))", 3)} AS disruption_rate
FROM layouts GROUP BY GROUPING SETS ((), (kind), (unit), (naming))""",
    "ingest_format_check": """WITH shots AS (SELECT DISTINCT user_id % 12 AS s FROM events)
SELECT machine, count(*) AS n_shots, count(DISTINCT CASE WHEN s % 2 = 1 THEN 2 ELSE CAST(s % 4 = 0 AS INTEGER) END) <= 1 AS is_homogeneous
FROM (SELECT s, unnest(['all', 'M' || s % 2]) AS machine FROM shots) GROUP BY machine""",
    "ml_stratified_folds": """SELECT doc_id, quality, CAST((row_number() OVER (
  PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""",
}
ORACLES["ml_rf_cv_check"] = f"""SELECT fold, count(*) AS n_rows, CAST(sum(quality) AS BIGINT) AS n_positive, TRUE AS separates
FROM ({ORACLES["ml_stratified_folds"]}) WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY fold"""
