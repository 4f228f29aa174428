"""Ingestion of raw recordings ``shot_*/{signals.csv|signals.json, metadata.yaml}``.

The number of Spark jobs and plan nodes depends on neither the number of recordings nor the
number of layouts. Raw text is parsed once and landed as Parquet in the scratch folder; the
cleaning steps make several passes over that table, not over the text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.files import arrow_path, arrow_reaches
from tidegrid.functions.numeric import null_if_nan, round_exactly
from tidegrid.session import broadcast_if_small, materialize
from tidegrid.sources.json_text import read_records
from tidegrid.sources.registry import SourceRegistry

# Tie-breakers for rows of one recording with equal times: their place in the source file.
SOURCE_ORDER = ("source_block", "source_row")

# The keys of a metadata record with their types, and the texts that stand for a
# missing number in a CSV file.
METADATA_FIELDS = {
    "shot_id": "bigint",
    "duration_s": "double",
    "sampling_hz": "int",
    "disruption": "boolean",
    "disruption_time_s": "double",
    "file_format": "string",
    "current_unit": "string",
    "column_naming_scheme": "string",
    "operator": "string",
    "machine_config": "string",
}
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Recordings:
    """Canonical signals, one metadata row per good recording, one error row per bad one."""

    signals: DataFrame
    metadata: DataFrame
    errors: DataFrame


def load_recordings(
    spark: SparkSession,
    raw_dir: str,
    registry: SourceRegistry | None = None,
    extra_columns: Sequence[str] = (),
    pattern: str = "shot_*",
) -> Recordings:
    """Ingest all recordings; a bad one ends up in ``errors`` and does not stop the others.

    ``extra_columns`` names raw columns beyond the canonical ones to carry along as doubles.
    """
    registry = registry or SourceRegistry.default()
    root = f"{raw_dir.rstrip('/')}/{pattern}"
    metadata = read_metadata(spark, root)
    headers = _csv_headers(spark, f"{root}/signals.csv")
    records = _json_records(spark, f"{root}/signals.json")
    found = materialize(headers.unionByName(_json_keys(records)), "headers")
    shots = materialize(_check(metadata, found, registry), "shots")

    good = shots.where("error is null")
    rows = _csv_rows(spark, f"{root}/signals.csv", good, found, registry, extra_columns)
    rows = rows.unionByName(_json_rows(records, good, registry, extra_columns))
    landed = materialize(rows, "signals")

    late, n_late = broadcast_if_small(_late_errors(good, landed))
    if n_late is None:
        late = materialize(late, "errors")
    if n_late != 0:
        good = good.join(late, "shot_dir", "left_anti")
        landed = landed.join(late, "shot_dir", "left_anti")
    errors = shots.where("error is not null").select("shot_dir", "error").unionByName(late)
    canonical = list(registry.canonical_columns.values())
    return Recordings(
        landed.select("shot_id", *canonical, *extra_columns, *SOURCE_ORDER),
        good.select("shot_dir", *METADATA_FIELDS, "schema_applied", "source_columns"),
        errors,
    )


def load_recording(
    spark: SparkSession, shot_dir: str, registry: SourceRegistry | None = None
) -> Recordings:
    """Ingest one recording; unlike the batch, this raises on a bad one."""
    parent, _, name = shot_dir.rstrip("/").rpartition("/")
    out = load_recordings(spark, parent, registry, pattern=name)
    error = out.errors.first()
    if error:
        raise ValueError(f"{error.shot_dir}: {error.error}")
    return out


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Parse every ``metadata.yaml`` into typed columns plus ``fields``, all keys as text."""
    text = _load(
        spark, lambda: spark.read.text(f"{root}/metadata.yaml", wholetext=True), "value string"
    )
    text = text.select(_shot_dir().alias("shot_dir"), "value")
    fields = "shot_dir string, fields map<string,string>, error string"

    def parse(batches):
        import yaml

        def one(value):
            try:
                doc = yaml.safe_load(value)
            except yaml.YAMLError as e:
                return None, f"metadata.yaml is not valid YAML: {str(e).splitlines()[0]}"
            if not isinstance(doc, dict):
                return None, "metadata.yaml holds no key/value record"
            return {str(k): None if v is None else str(v) for k, v in doc.items()}, None

        for pdf in batches:
            parsed = [one(v) for v in pdf["value"]]
            pdf["fields"] = [p[0] for p in parsed]
            pdf["error"] = [p[1] for p in parsed]
            yield pdf[["shot_dir", "fields", "error"]]

    parsed = text.mapInPandas(parse, fields)
    return parsed.select(
        "shot_dir",
        "fields",
        *[
            F.col("fields")[name].try_cast(kind).alias(name)
            for name, kind in METADATA_FIELDS.items()
        ],
        "error",
    )


def error_sample(errors: DataFrame, n: int = 5) -> DataFrame:
    return errors.orderBy("shot_dir").limit(n)


def schema_usage(metadata: DataFrame) -> DataFrame:
    return (
        metadata.groupBy("schema_applied")
        .agg(F.count(F.lit(1)).alias("n_shots"))
        .orderBy("schema_applied")
    )


def format_check(metadata: DataFrame) -> DataFrame:
    """Whether all recordings deliver the same canonical columns in the same order."""
    return metadata.agg(
        F.count(F.lit(1)).alias("n_shots"),
        (F.count_distinct(F.to_json("source_columns")) <= 1).alias("is_homogeneous"),
    )


def preview(recordings: Recordings, rows: int = 3) -> tuple[DataFrame, int]:
    """First rows and row count of the first recording."""
    first = recordings.metadata.orderBy("shot_dir").limit(1).select("shot_id").first()
    if first is None:
        return recordings.signals.limit(0), 0
    shot = recordings.signals.where(F.col("shot_id") == first.shot_id)
    return shot.orderBy("time_s", *SOURCE_ORDER).limit(rows), shot.count()


def dataset_summary(metadata: DataFrame) -> DataFrame:
    """Totals and event rate, and counts per format, unit and naming scheme, in one pass."""
    dims = ["file_format", "current_unit", "column_naming_scheme"]
    counts = metadata.groupingSets([[], *[[d] for d in dims]], *dims).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("n_shots"),
        F.count_if("disruption").alias("n_disruptions"),
    )
    dimension = F.element_at(
        F.create_map(
            *[x for g, d in ((7, "total"), (3, dims[0]), (5, dims[1]), (6, dims[2]))
              for x in (F.lit(g), F.lit(d))]
        ),
        F.col("_g").cast("int"),
    )
    rated = counts.select(
        dimension.alias("dimension"),
        F.coalesce(*dims).alias("value"),
        "n_shots",
        "n_disruptions",
        (F.col("n_disruptions") / F.col("n_shots")).alias("_rate"),
    )
    return rated.withColumn("disruption_rate", F.expr(round_exactly("_rate", 3))).drop("_rate")


def apply_schema(
    df: DataFrame, registry: SourceRegistry, schema_name: str, keep_extra: bool = False
) -> DataFrame:
    """Rename and convert one raw frame whose schema is known; raises if a column is missing."""
    schema = registry.schemas[schema_name]
    missing = [c for c in schema["expected_columns"] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    out, used = [], set()
    for canonical, choices in zip(registry.canonical_columns.values(), registry.columns_of(schema)):
        for raw, factor in choices:
            if raw in df.columns:
                out.append((null_if_nan(F.col(f"`{raw}`").cast("double")) * factor).alias(canonical))
                used.add(raw)
                break
    extra = [F.col(f"`{c}`") for c in df.columns if c not in used] if keep_extra else []
    return df.select(*out, *extra)


def _load(spark: SparkSession, read, schema: str) -> DataFrame:
    """``read()``, or no rows when the path pattern matches no file."""
    try:
        return read().select("*", "_metadata")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        meta = (
            "_metadata struct<file_path: string, file_block_start: bigint, file_block_length: bigint, file_size: bigint>"
        )
        return spark.createDataFrame([], f"{schema}, {meta}")


def _shot_dir() -> Column:
    return F.regexp_extract("_metadata.file_path", r"^(.*?/[^/]+)/(?:metadata\.yaml|signals\.csv|signals\.json)(?:/.*)?$", 1)


def _csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """Column names of every CSV file: its first line that is not blank.

    Tasks open each file and stop behind that line, so that the rows are read only once, later on. In a store that
    only Spark's readers can open, the first lines are found by a scan of the text.
    """
    lines = _first_lines(spark, path) if arrow_reaches(path) else _scanned_lines(spark, path)
    first = lines.groupBy("shot_dir").agg(F.min(F.struct("file", "at", "value")).alias("line"))
    names = F.transform(
        F.split(F.regexp_replace("line.value", "^﻿|\r$", ""), ","),
        lambda c: F.regexp_replace(F.trim(c), '^"(.*)"$', "$1"),
    )
    return first.select(
        "shot_dir", F.lit("csv").alias("kind"), names.alias("found"), F.lit(0).cast("long").alias("broken")
    )


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """The first line of every file; Spark lists the files and opens none of them."""
    files = _load(spark, lambda: spark.read.format("binaryFile").load(path), "path string")
    named = files.select(_shot_dir().alias("shot_dir"), F.col("_metadata.file_path").alias("file"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return named.repartition(tasks, "file").mapInArrow(_read_first_lines, "shot_dir string, file string, at bigint, value string")


def _read_first_lines(batches):
    import pyarrow as pa

    for batch in batches:
        lines = [_first_line(file) for file in batch.column(1).to_pylist()]
        at = pa.array([0] * len(lines), pa.int64())
        rows = pa.RecordBatch.from_arrays(
            [*batch.columns, at, pa.array(lines, pa.string())], names=["shot_dir", "file", "at", "value"]
        )
        yield rows.filter(pa.array([line is not None for line in lines], pa.bool_()))


def _first_line(file: str, block: int = 1 << 16) -> str | None:
    """The first line of a file that is not blank, read block by block."""
    store, name = arrow_path(unquote(file))
    with store.open_input_stream(name, buffer_size=None) as source:
        rest, more = b"", True
        while more:
            read = source.read(block)
            rest, more = rest + read, bool(read)
            lines = rest.splitlines(keepends=True)
            whole = lines if not more else lines[:-1]
            found = next((line for line in whole if line.strip()), None)
            if found is not None:
                return found.decode("utf-8", errors="replace").rstrip("\r\n")
            rest = b"" if not lines or not more else lines[-1]
    return None


def _scanned_lines(spark: SparkSession, path: str) -> DataFrame:
    text = _load(spark, lambda: spark.read.text(path), "value string")
    return text.where("_metadata.file_block_start = 0").select(
        _shot_dir().alias("shot_dir"),
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    ).where("trim(value) <> ''")


def _json_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of every JSON file, as a map of texts.

    Text cut at closing braces lets Spark split a large file between tasks.
    """
    text = _load(spark, lambda: spark.read.option("lineSep", "}").text(path), "value string")
    meta = F.col("_metadata")
    return read_records(
        text.select(
            _shot_dir().alias("shot_dir"),
            meta["file_path"].alias("file"),
            meta["file_block_start"].alias("source_block"),
            (meta["file_block_length"] >= meta["file_size"]).alias("whole"),
            "value",
        )
    )


def _json_keys(records: DataFrame) -> DataFrame:
    """Union of the keys in each JSON file; there are few distinct key lists per file."""
    keys = F.collect_set(F.map_keys("record"))
    return records.groupBy("shot_dir").agg(
        F.lit("json").alias("kind"),
        F.array_distinct(F.flatten(F.sort_array(keys))).alias("found"),
        F.count_if(F.col("record").isNull()).alias("broken"),
    )


def _check(metadata: DataFrame, found: DataFrame, registry: SourceRegistry) -> DataFrame:
    """All checks that need no signal rows; ``error`` holds the first one that fails."""
    spark = metadata.sparkSession
    fields = F.col("fields")
    absent = [
        F.when(~F.map_contains_key("fields", F.lit(k)), F.lit(k)) for k in registry.template_keys
    ]
    key_missing = reduce(lambda a, b: a | b, [a.isNotNull() for a in absent], F.lit(False))
    name = registry.schema_name(fields)
    known = ", ".join(registry.schemas)
    shots = metadata.withColumn("schema_applied", name).withColumnRenamed("error", "_unreadable")
    shots = shots.join(registry.table(spark), "schema_applied", "left")
    files = found.groupBy("shot_dir").agg(
        *[
            F.first(F.when(F.col("kind") == kind, F.struct("found", "broken")), ignorenulls=True).alias(kind)
            for kind in ("csv", "json")
        ]
    )
    shots = shots.join(files, "shot_dir", "full_outer")
    shots = shots.withColumn(
        "_file", F.when(F.col("file_format") == "csv", F.col("csv")).when(F.col("file_format") == "json", F.col("json"))
    ).withColumn("found", F.col("_file.found"))
    missing = F.array_except("expected", "found")
    shots = shots.withColumn("picked", F.when(F.col("found").isNotNull(), _first_choice()))
    error = (
        F.when(F.col("_unreadable").isNotNull(), F.col("_unreadable"))
        .when(fields.isNull(), "metadata.yaml is missing")
        .when(
            key_missing,
            F.concat(F.lit("insufficient metadata to resolve the schema: "), F.concat_ws(", ", *absent)),
        )
        .when(F.col("schema_applied").isNull(), "a metadata key of the schema name has no value")
        .when(
            F.col("expected").isNull(),
            F.concat(F.lit("unknown schema "), "schema_applied", F.lit(f"; known: {known}")),
        )
        .when(F.col("file_format").isNull(), "metadata has no file_format")
        .when(
            ~F.col("file_format").isin("csv", "json"),
            F.concat(F.lit("unsupported file format: "), "file_format"),
        )
        .when(F.col("found").isNull(), F.concat(F.lit("no data in signals."), "file_format"))
        .when(F.col("_file.broken") > 0, "malformed record in signals.json")
        .when(
            F.size(missing) > 0,
            F.concat(
                F.lit("missing columns "), F.to_json(missing), F.lit("; found "), F.to_json("found")
            ),
        )
        .when(F.col("picked")[0].isNull(), "no time column")
        .when(F.col("shot_id").isNull(), "metadata has no integer shot_id")
    )
    return shots.select(
        "shot_dir", *METADATA_FIELDS, "schema_applied", "picked", _canonical_order(registry).alias("source_columns"),
        error.alias("error"),
    )


def _first_choice() -> Column:
    return F.expr(
        "transform(columns, choices -> "
        "try_element_at(filter(choices, c -> array_contains(found, c.raw)), 1))"
    )


def _canonical_order(registry: SourceRegistry) -> Column:
    """Canonical names of the file's columns, in file order, other columns under their own name."""
    names = F.array(*[F.lit(c) for c in registry.canonical_columns.values()])
    raws = F.transform("picked", lambda p: p.raw)
    return F.transform(
        "found",
        lambda raw: F.when(
            F.array_contains(raws, raw), F.get(names, (F.array_position(raws, raw) - 1).cast("int"))
        ).otherwise(raw),
    )


def _csv_rows(spark, path, good, found, registry, extra) -> DataFrame:
    """All CSV files through one reader.

    Cells are read by position as text, one column more than the widest header, and each file's
    own header tells which position holds which column.
    """
    widest = found.where("kind = 'csv'").agg(F.max(F.size("found"))).first()[0] or 0
    columns = [f"c{i}" for i in range(widest + 1)]
    schema = ", ".join(f"{c} string" for c in columns)
    cells = _load(
        spark, lambda: spark.read.schema(schema).option("header", True).csv(path), schema
    ).select(
        _shot_dir().alias("shot_dir"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
        F.array(*columns).alias("cells"),
    )
    header = found.where("kind = 'csv'").select("shot_dir", "found")
    shots = good.where("file_format = 'csv'").join(header, "shot_dir")
    n = len(registry.canonical_columns)
    shots = shots.select(
        "shot_dir",
        "shot_id",
        F.size("found").alias("_width"),
        *[
            F.nullif(F.array_position("found", F.col("picked")[j].raw), F.lit(0)).cast("int").alias(f"_at{j}")
            for j in range(n)
        ],
        *[
            F.nullif(F.array_position("found", F.lit(c)), F.lit(0)).cast("int").alias(f"_at{n + j}")
            for j, c in enumerate(extra)
        ],
        *[F.col("picked")[j].factor.alias(f"_f{j}") for j in range(n)],
    )
    shots, _ = broadcast_if_small(shots)
    rows = cells.join(shots, "shot_dir")
    too_long = F.exists(
        F.slice("cells", F.col("_width") + 1, F.lit(len(columns))), lambda c: c.isNotNull()
    )
    texts = [
        F.get("cells", F.col(f"_at{j}") - 1) for j in range(n + len(extra))
    ]
    return _typed(rows, texts, registry, extra, F.when(too_long, "row with too many fields"))


def _json_rows(records, good, registry, extra) -> DataFrame:
    n = len(registry.canonical_columns)
    shots = good.where("file_format = 'json'").select(
        "shot_dir",
        "shot_id",
        *[F.col("picked")[j].raw.alias(f"_at{j}") for j in range(n)],
        *[F.col("picked")[j].factor.alias(f"_f{j}") for j in range(n)],
    )
    shots, _ = broadcast_if_small(shots)
    rows = records.join(shots, "shot_dir")
    texts = [F.try_element_at("record", F.col(f"_at{j}")) for j in range(n)]
    texts += [F.try_element_at("record", F.lit(c)) for c in extra]
    return _typed(rows, texts, registry, extra, F.lit(None).cast("string"))


def _typed(rows, texts, registry, extra, defect) -> DataFrame:
    """Texts to canonical doubles; ``defect`` names the first thing wrong with a row."""
    names = list(registry.canonical_columns.values())
    cells = {f"_x{j}": _cell(t) for j, t in enumerate(texts)}
    rows = rows.withColumns(cells).withColumns(
        {f"_y{j}": _number(F.col(x)) for j, x in enumerate(cells)}
    )
    rows = rows.withColumn("defect", defect)
    for j, name in enumerate([*names, *extra]):
        wrong = F.col(f"_x{j}").isNotNull() & F.col(f"_y{j}").isNull()
        rows = rows.withColumn("defect", F.coalesce("defect", F.when(wrong, f"non-numeric text in {name}")))
    value = [
        null_if_nan(F.col(f"_y{j}") * (F.col(f"_f{j}") if j < len(names) else F.lit(1.0))).alias(name)
        for j, name in enumerate([*names, *extra])
    ]
    rows = rows.select("shot_dir", "shot_id", *value, *SOURCE_ORDER, "defect")
    timed = F.coalesce(F.abs(names[0]) < float("inf"), F.lit(False))
    return rows.withColumn("defect", F.coalesce("defect", F.when(~timed, "row without a time")))


def _cell(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(*MISSING_TEXTS), trimmed)


def _number(text: Column) -> Column:
    """A number, or NULL; the JVM would take a type suffix such as ``1.5f`` for one."""
    suffix = F.lower(F.right(text, F.lit(1)))
    suffixed = suffix.isin("d", "f") & ~F.lower(text).endswith("inf")
    return F.when(~suffixed, text.try_cast("double"))


def _late_errors(good: DataFrame, landed: DataFrame) -> DataFrame:
    """Errors seen only in the rows, then recordings whose id a later directory uses again."""
    defects = (
        landed.where("defect is not null").groupBy("shot_dir").agg(F.min("defect").alias("error"))
    )
    left = good.join(defects, "shot_dir", "left_anti")
    last = left.groupBy("shot_id").agg(F.max("shot_dir").alias("shot_dir"))
    repeated = left.join(last, "shot_dir", "left_anti").select(
        "shot_dir", F.concat(F.lit("shot_id "), "shot_id", F.lit(" is used by a later directory")).alias("error")
    )
    return defects.unionByName(repeated)
